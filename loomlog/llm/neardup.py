"""MinHash near-dedup with bottom-k sketches from one hash function.

A document is the set of 64-bit hashes of its ``size``-word shingles; its
sketch is the ``KEEP`` smallest of them.  Documents with equal sets are one
class (it has a number, and the text of its smallest id stands for it), so exact
copies cost one row each.

Candidates.  The smallest values of each sketch go to inverted lists, one per
(value, size band); two bands per class overlap, so classes whose sizes allow
a link share one.  No list is expanded into pairs: each
gets a hub, the class whose values are the most shared, and every member
meets the hub only.  The sketch of the union (the smallest ``KEEP`` of both)
estimates the overlap and drops far pairs; the rest are verified on full sets.

That is enough, because Jaccard distance is a metric, and:

* members linked with the hub are connected through it;
* if ``y`` or ``z`` is not linked with hub ``h`` but ``y`` and ``z`` are linked,
  they share part of what sets them apart from ``h``.  For members near a hub
  (Jaccard ``NEAR`` or more) the verification returns these differences; a
  prefix filter on them (rarest first) finds the pairs, and
  ``|y ^ z| = |(y ^ h) ^ (z ^ h)|`` verifies them exactly;
* a member above ``FAR`` (``far_at`` the threshold) is linked with near ones only.  Those below, where a
  list has two of them, go on to narrower lists (of two, three, …
  neighbouring values, ``RUNS``) with hubs of their own; a hub that shares a
  run with them and yet is far from them gets ever rarer;
* whatever the rounds leave open (all members that were below ``FAR`` in a
  list of the first round) is settled exactly at the end: a prefix filter on
  their full sets, rarest shingles first, finds every pair the hubs did not
  bring together (``_left_over``).

Links are then closed by label propagation with pointer jumping on written
tables.  Nothing is capped.  The chance that a link escapes is that of two
similar sketches sharing no value of the first round, or of an estimate off by
more than three standard deviations on the way to a hub that one of them is
above ``FAR`` with; measured: none missed.

Edge cases: null or empty text, or one without words: n_shingles 0, linked
with nothing, kept.  Rows with a null id: component null, kept.  Repeated
rows are copies of each other: all carry the same component (``kept`` holds
for each row whose id is the component's).  Rows that share an id and differ in
text are documents of their own: each is linked by its own text, ``text_hash``
(xxhash64 of the text) says which of them a result row is.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm import textbytes as B
from loomlog.llm.common import importable, short_batches, written

SIZE = 5                             # words of a shingle
KEEP = 32                            # values of a sketch
#: rounds of inverted lists: (neighbouring values a list is made of, of how many values of the sketch)
RUNS = ((1, 10), (2, 16), (3, 24), (4, 32), (6, 32), (8, 32))
PERCENT = 85                         # 100 * intersection >= PERCENT * union
NEAR = 0.42                          # Jaccard with the hub from which on differences are kept
TURNS = 4                            # centres a long list of differences has at most, one after the other
WORTH = 0.02                         # share of its open members a turn has to connect for another one to follow
LIKELY = 0.18                        # NEAR less three standard deviations of the estimate


def far_at(percent: int) -> float:
    """``FAR``: NEAR plus the distance of a link; anything linked to a member above it is near."""
    return NEAR + 1 - percent / 100


def _sets(s: B.Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes row after row, bounds of the rows)."""
    w = B.words(s, B.SPACES)
    code, row = B.shingle_hashes(w, B.word_hashes(s, w), size)
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    return code[fresh], np.searchsorted(row[fresh], np.arange(s.hi - s.lo + 1))


def sketches(docs: DataFrame, text: str, doc_id: str, size: int = SIZE) -> DataFrame:
    """doc_id, t (hash of the text), n (set size), f1, f2 (fingerprint of the set), sketch of every row."""
    def run(batches):
        for batch in batches:
            for s in B.slices(batch.column("text")):
                code, first = _sets(s, size)
                n = np.diff(first)
                prints = [B.row_sums(B.mix(code ^ np.uint64(salt)), first).astype(np.int64) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                kept = np.minimum(n, KEEP)
                bounds = np.concatenate([[0], np.cumsum(kept)])
                at = np.repeat(first[:-1] - bounds[:-1], kept) + np.arange(bounds[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s.lo, s.hi - s.lo), batch.column("t").slice(s.lo, s.hi - s.lo), pa.array(n.astype(np.int64)), pa.array(prints[0]), pa.array(prints[1]),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((code[at] >> np.uint64(1)).astype(np.int64)))],
                    ["doc_id", "t", "n", "f1", "f2", "sketch"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, t long, n long, f1 long, f2 long, sketch array<long>")


def verify(pairs: DataFrame, texts: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(hub, id, both, n_hub, n_id, link, apart) of pairs (hub, id): the full sets
    compared.  apart: the hashes in one set only, odd for those of the hub;
    given from ``NEAR`` on."""
    rows = pairs.join(texts.select(F.col("rep").alias("id"), F.col("text").alias("id_text")), "id")
    rows = rows.join(texts.select(F.col("rep").alias("hub"), F.col("text").alias("hub_text")), "hub")

    def run(batches):
        last, mine = None, None
        for batch in batches:
            hubs = batch.column("hub").to_numpy()
            hub_text = batch.column("hub_text")
            out: list[tuple] = []
            for s in B.slices(batch.column("id_text")):
                code, first = _sets(s, size)
                for r in range(s.hi - s.lo):
                    if hubs[s.lo + r] != last:
                        last = hubs[s.lo + r]
                        mine = next(_sets(t, size)[0] for t in B.slices(hub_text.slice(s.lo + r, 1)))
                    theirs = code[first[r]:first[r + 1]]
                    place = np.searchsorted(mine, theirs)
                    place[place == len(mine)] = 0
                    shared = mine[place] == theirs if len(mine) else np.zeros(len(theirs), bool)
                    both = int(shared.sum())
                    union = len(mine) + len(theirs) - both
                    link, apart = 100 * both >= percent * union, np.zeros(0, np.int64)
                    if both >= NEAR * union:
                        gone = np.ones(len(mine), bool)
                        gone[place[shared]] = False
                        apart = np.concatenate([theirs[~shared] & ~np.uint64(1), mine[gone] | np.uint64(1)]).view(np.int64)
                    out.append((both, len(mine), len(theirs), link, apart))
            if out:
                both, n_hub, n_id, link, apart = zip(*out, strict=True)
                bounds = np.concatenate([[0], np.cumsum([len(a) for a in apart])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("hub"), batch.column("id"), pa.array(both, pa.int64()), pa.array(n_hub, pa.int64()), pa.array(n_id, pa.int64()),
                     pa.array(link, pa.bool_()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(apart), pa.int64()))],
                    ["hub", "id", "both", "n_hub", "n_id", "link", "apart"])

    return rows.select("hub", "id", "hub_text", "id_text").mapInArrow(
        run, "hub long, id long, both long, n_hub long, n_id long, link boolean, apart array<long>")


def union_estimate(a, b):
    """Jaccard of two sets by the sketch of their union: of its smallest KEEP values, the share in both."""
    low = F.slice(F.array_sort(F.array_union(a, b)), 1, KEEP)
    return F.size(F.array_intersect(F.array_intersect(low, a), b)) / F.size(low)


def _lists(members: DataFrame, run: int, width: int, percent: int) -> DataFrame:
    """(key, rep, central): the inverted lists of runs of ``run`` neighbouring
    values among the first ``width`` of each sketch, in both size bands."""
    band = F.floor(F.log(F.col("n")) / F.lit(float(np.log(100 / percent)))).cast("long")
    values = F.slice("sketch", 1, width)
    last = F.greatest(F.size(values) - run, F.lit(0))               # a sketch shorter than the run is one run
    runs = F.transform(F.sequence(F.lit(0), last), lambda at: F.xxhash64(F.slice(values, at + 1, F.lit(run))))
    keys = F.flatten(F.transform(F.array(band, band + 1), lambda b: F.transform(runs, lambda r: F.xxhash64(r, b))))
    return members.select(F.explode(F.array_distinct(keys)).alias("key"), "rep", "central")


def _stars(lists: DataFrame) -> DataFrame:
    """(key, hub, rep) of the members, hubs left out, of lists of two or more; the most central class is the hub."""
    hubs = lists.groupBy("key").agg(F.count(F.lit(1)).alias("members"),
                                    F.max(F.struct("central", (-F.col("rep")).alias("minus"))).alias("best"))
    hubs = hubs.where("members > 1").select("key", (-F.col("best.minus")).alias("hub"))
    return written(lists.select("key", "rep").join(hubs, "key").where("hub <> rep"), "dup-lists")


def _central(members: DataFrame, width: int, percent: int) -> DataFrame:
    """``members`` that share a list, with ``central``: how many members all their lists have together."""
    lists = _lists(members.withColumn("central", F.lit(0)), 1, width, percent)
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    central = lists.join(sizes, "key").groupBy("rep").agg(F.sum("size").alias("central"))
    return written(members.join(central, "rep"), "dup-members")


def _between(near: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one hub of which one at least is not
    linked with it, from verified pairs with their differences: all that their
    components need.  In long lists of a difference members are first compared
    with one member that is connected with the hub; those linked with it are
    connected too, and pairs are looked for among the others and with them only.
    Turns end where one connects few: what is left is paired either way."""
    far_side = 100 - percent
    open_hubs = near.where(f"NOT link AND both >= {far_at(percent)} * (n_hub + n_id - both)").select("hub").distinct()
    rows = near.where(F.size("apart") > 0).join(open_hubs, "hub", "left_semi")
    # one table: each turn and the pairs at the end read it twice
    rows = written(rows.where(f"both >= {NEAR} * (n_hub + n_id - both)").select(
        "hub", "id", "n_id", "link", "apart", F.size("apart").cast("long").alias("d")), "dup-near")
    # sym <= far/100 * union and union <= n / (percent/100): at most `most` hashes set two linked
    # members apart, so two with d and d' differences share at least (d + d' - most) / 2 of them,
    # and one of them at least; as they cannot share more than d', each shares d - most at least
    most = lambda n: F.floor(n * far_side / percent)
    items = rows.select("hub", "id", "link", "d", "n_id", F.explode("apart").alias("e"))
    often = items.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("often"))
    items = items.join(often, ["hub", "e"])
    items = items.withColumn("place", F.row_number().over(Window.partitionBy("hub", "id").orderBy("often", "e")))
    reach = F.col("d") - F.greatest(F.lit(1), F.col("d") - most(F.col("n_id"))) + 1
    # one row a member, with its differences as a list: what a turn finds goes to members, not to each difference
    items = items.where((F.col("often") > 1) & (F.col("place") <= reach)).groupBy("hub", "id").agg(
        F.first("link").alias("link"), F.first("d").alias("d"), F.first("n_id").alias("n_id"), F.collect_list(F.struct("e", "place")).alias("es"))
    members = written(items, "dup-differences")
    each = lambda members: members.select("hub", "id", "link", "d", "n_id", F.inline("es"))
    # the lists are made once; a turn goes over the members not connected with their hub, and over the lists of those it connects
    joined, opened = members.where("link"), members.where("NOT link")
    lists, links = _lists_of_differences(each(members), F.lit(1), F.when(F.col("link"), 0).otherwise(1)), []
    for turn in range(TURNS):
        met = written(_together(lists), "dup-met-lists")
        size = met.agg(F.sum(F.col("all") * F.col("open")).alias("pairs"), F.sum("all").alias("rows")).first()
        if (size["pairs"] or 0) <= 2 * (size["rows"] or 0):        # the lists are short
            break
        centres = met.select("hub", "e", "open", F.col(f"best{turn}.y").alias("y")).where("open > 0 AND y IS NOT NULL")
        found = written(_through_centres(each(opened), centres, rows, percent), "dup-centred")
        links.append(found.select("a", "b"))
        now = found.select("hub", F.col("b").alias("id"), F.lit(True).alias("now")).distinct()
        after = written(opened.join(now, ["hub", "id"], "left").withColumn("link", F.coalesce("now", "link")).drop("now"), "dup-differences")
        new, opened = after.where("link"), after.where("NOT link")
        joined = joined.unionByName(new)
        passed = after.agg(F.count(F.when(F.col("link"), 1)).alias("new"), F.count(F.lit(1)).alias("rows")).first()
        if passed["new"] < WORTH * passed["rows"]:
            break
        # the new ones are in the lists already: there they are open no more, and may be centres
        lists = met.unionByName(_lists_of_differences(each(new), F.lit(0), F.lit(-1)))
    items = each(joined).unionByName(each(opened))
    opened = each(opened).select("hub", "e", F.col("id").alias("z"), F.col("d").alias("dz"), F.col("n_id").alias("nz"),
                                            F.col("place").alias("pz"))
    others = items.select(F.col("hub").alias("o_hub"), F.col("e").alias("o_e"), F.col("id").alias("y"), F.col("link").alias("ly"),
                          F.col("d").alias("dy"), F.col("n_id").alias("ny"), F.col("place").alias("py"))
    shared = F.greatest(F.lit(1), F.ceil((F.col("dz") + F.col("dy") - most(F.least("nz", "ny"))) / 2))
    # so a linked pair meets within the first d - shared + 1 differences of both, rarest first
    meet = ((F.col("hub") == F.col("o_hub")) & (F.col("e") == F.col("o_e")) & (F.col("ly") | (F.col("y") < F.col("z")))
            & (F.col("z") != F.col("y")) & (F.col("pz") <= F.col("dz") - shared + 1) & (F.col("py") <= F.col("dy") - shared + 1))
    pairs = opened.join(others, meet).select("hub", "y", "z").distinct()
    last = _linked_differences(pairs, rows, percent).select("a", "b")
    return reduce(DataFrame.unionByName, links, last)


def _lists_of_differences(items: DataFrame, counted: Column, is_open: Column) -> DataFrame:
    """(hub, e, all, open, best0, …), a row an item: what it adds to the numbers of members that hold the difference and of
    those of them not yet connected with the hub, and for each turn (order, y), where it is connected and so may be the centre."""
    centre = lambda turn: F.when(F.col("link"), F.struct(F.xxhash64("id", F.lit(turn)).alias("order"), F.col("id").alias("y")))
    return items.select("hub", "e", counted.cast("long").alias("all"), is_open.cast("long").alias("open"),
                        *[centre(turn).alias(f"best{turn}") for turn in range(TURNS)])


def _together(lists: DataFrame) -> DataFrame:
    """One row a list (hub, e): members, open ones, and the centre of each turn (null: none is connected)."""
    return lists.groupBy("hub", "e").agg(F.sum("all").alias("all"), F.sum("open").alias("open"),
                                         *[F.max(f"best{turn}").alias(f"best{turn}") for turn in range(TURNS)])


def _through_centres(opened: DataFrame, centres: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (hub, a, b) of members b not yet connected with their hub with the centre a of a
    list they are in (no two members are compared otherwise)."""
    pairs = opened.select("hub", "e", F.col("id").alias("z")).join(centres, ["hub", "e"]).select("hub", "y", "z").distinct()
    return _linked_differences(pairs, rows, percent)


def _linked_differences(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(hub, a, b) of the pairs (hub, y, z) that are linked, by their differences from the hub."""
    one = rows.select(F.col("hub").alias("y_hub"), F.col("id").alias("y_id"), F.col("n_id").alias("n_y"), F.col("apart").alias("d_y"))
    two = rows.select(F.col("hub").alias("z_hub"), F.col("id").alias("z_id"), F.col("n_id").alias("n_z"), F.col("apart").alias("d_z"))
    pairs = pairs.join(one, (F.col("hub") == F.col("y_hub")) & (F.col("y") == F.col("y_id"))).join(
        two, (F.col("hub") == F.col("z_hub")) & (F.col("z") == F.col("z_id")))
    apart = F.size("d_y") + F.size("d_z") - 2 * F.size(F.array_intersect("d_y", "d_z"))
    union = (F.col("n_y") + F.col("n_z") + apart) / 2
    return pairs.where(100 * (union - apart) >= percent * union).select("hub", F.col("y").alias("a"), F.col("z").alias("b"))


def shingle_rows(texts: DataFrame, size: int) -> DataFrame:
    """(rep, n, e) for every distinct shingle hash e of the texts (rep, text)."""
    def run(batches):
        for batch in batches:
            for s in B.slices(batch.column("text")):
                code, first = _sets(s, size)
                n = np.diff(first)
                rep = batch.column("rep").to_numpy()[s.lo:s.hi]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rep, n)), pa.array(np.repeat(n, n)), pa.array(code.view(np.int64))],
                                                 ["rep", "n", "e"])

    return texts.select("rep", "text").mapInArrow(run, "rep long, n long, e long")


def _left_over(members: DataFrame, met: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (hub, id) of members (rep) that may be linked and did not meet a hub
    which settles them: every such pair is among these.

    Linked sets of sizes n and m share at least s = percent (n + m) / (100 + percent)
    shingles, so in any one order of all shingles they share one of their first
    n - s + 1 and m - s + 1.  Members above ``FAR`` with one hub are settled
    among themselves, so only pairs of different such groups are listed."""
    close = met.where(f"both >= {far_at(percent)} * (n_hub + n_id - both)").select("hub", F.col("id").alias("rep"))
    stars = close.groupBy("hub").agg(F.count(F.lit(1)).alias("star"))
    settled = close.join(stars, "hub").groupBy("rep").agg(F.max(F.struct("star", (-F.col("hub")).alias("minus"))).alias("best"))
    group = members.join(settled, "rep", "left").select(
        "rep", F.coalesce(-F.col("best.minus"), F.col("rep")).alias("group"))
    items = written(shingle_rows(texts.join(members, "rep", "left_semi"), size), "dup-shingles")
    often = written(items.groupBy("e").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "dup-often")
    # a shingle of one member only comes before all others and brings no pair: it is counted, not sorted
    items = items.join(often, "e")
    place = F.row_number().over(Window.partitionBy("rep").orderBy("often", "e"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("rep"))
    items = items.withColumn("place", place + F.col("n") - shared)
    # linked sets share at least percent of the larger, so of each
    items = items.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).join(group, "rep")
    items = written(items.select("e", "rep", "n", "place", "group"), "dup-prefixes")
    mixed = items.groupBy("e").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi").select("e")
    items = written(items.join(mixed, "e", "left_semi"), "dup-mixed")
    one = items.select("e", F.col("rep").alias("hub"), F.col("n").alias("n_y"), F.col("place").alias("p_y"), F.col("group").alias("g_y"))
    two = items.select(F.col("e").alias("e_z"), F.col("rep").alias("id"), F.col("n").alias("n_z"), F.col("place").alias("p_z"), F.col("group").alias("g_z"))
    least = F.ceil((F.col("n_y") + F.col("n_z")) * percent / (100 + percent))
    pairs = one.join(two, (F.col("e") == F.col("e_z")) & (F.col("hub") < F.col("id")) & (F.col("g_y") != F.col("g_z"))
                     & (100 * F.least("n_y", "n_z") >= percent * F.greatest("n_y", "n_z"))
                     & (F.col("p_y") <= F.col("n_y") - least + 1) & (F.col("p_z") <= F.col("n_z") - least + 1))
    before = met.select("hub", "id")
    before = before.unionByName(before.select(F.col("id").alias("hub"), F.col("hub").alias("id")))
    return written(pairs.select("hub", "id").distinct().join(before, ["hub", "id"], "left_anti"), "dup-left-over")


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id reachable over links (a, b), for every id in a link."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                     .select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(seen.select(F.col("a").alias("id"), "m"), "id").select(
            "id", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        after = written(lower.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        if not after.where("old <> label").limit(1).count():
            return after.select("id", "label")
        labels = after.select("id", "label")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash of every row."""
    importable(docs.sparkSession)
    with short_batches(docs.sparkSession):                         # all Python work is done when the result is planned
        return _near_duplicates(docs, text, doc_id, size, percent)


def _near_duplicates(docs: DataFrame, text: str, doc_id: str, size: int, percent: int) -> DataFrame:
    sk = written(sketches(docs, text, doc_id, size), "sketches")
    full = sk.where("n > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc_id", "t")).alias("at"), F.first("sketch").alias("sketch"))
    classes = written(classes.select("f1", "f2", "n", "at.doc_id", "at.t", "sketch", F.monotonically_increasing_id().alias("rep")), "classes")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))

    members = _central(classes.select("rep", "n", "sketch"), RUNS[0][1], percent)
    # the texts that may be compared, once for all rounds; the ids are a table of its own: its
    # size is known, so the texts of all others stay where they are if it is small
    at = written(classes.select("rep", "doc_id", "t").join(members.select("rep"), "rep", "left_semi"), "dup-needed")
    some = rows.join(written(at.select("doc_id").distinct(), "dup-ids"), "doc_id", "left_semi").dropDuplicates(["doc_id", "t"])
    texts = written(some.join(at, ["doc_id", "t"]).select("rep", "text"), "dup-texts")

    def checked(pairs: DataFrame) -> DataFrame:
        needed = written(pairs.select(F.explode(F.array("hub", "id")).alias("rep")).distinct(), "dup-needed")
        return verify(pairs, texts.join(needed, "rep", "left_semi"), size, percent)

    met, opened = None, None
    for run, width in RUNS:
        lists = _stars(_lists(members, run, width, percent))
        pairs = lists.select("hub", F.col("rep").alias("id")).distinct()
        if met is not None:                                        # verified in an earlier round
            pairs = pairs.join(met.select("hub", "id"), ["hub", "id"], "left_anti")
        sketch_of = lambda name: members.select(F.col("rep").alias(name), F.col("sketch").alias(f"s_{name}"))  # noqa: E731, B023
        likely = pairs.join(sketch_of("id"), "id").join(sketch_of("hub"), "hub").where(
            union_estimate(F.col("s_id"), F.col("s_hub")) >= LIKELY).select("hub", "id")
        found = written(checked(written(likely, "dup-pairs")), "dup-verified")
        met = found if met is None else met.unionByName(found)
        close = met.where(f"both >= {far_at(percent)} * (n_hub + n_id - both)").select("hub", F.col("id").alias("rep"))
        far = lists.join(close, ["hub", "rep"], "left_anti")
        shared = far.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
        members = written(members.join(far.join(shared, "key").select("rep").distinct(), "rep", "left_semi"), "dup-members")
        opened = members.select("rep") if opened is None else opened
        if not members.limit(1).count():
            break
    met = written(met, "dup-met")                                  # one table: the plans below read it many times
    links = met.where("link").select(F.col("hub").alias("a"), F.col("id").alias("b")).unionByName(_between(met, percent))
    links = written(links, "dup-links")
    late = checked(_left_over(opened, met, texts, size, percent))
    links = links.unionByName(late.where("link").select(F.col("hub").alias("a"), F.col("id").alias("b")))
    labels = written(components(links).join(classes.select(F.col("rep").alias("id"), "doc_id"), "id"), "dup-labels")
    least = labels.groupBy("label").agg(F.min("doc_id").alias("component"))
    linked = labels.join(least, "label").select(F.col("id").alias("rep"), "component")
    of_class = classes.join(linked, "rep", "left").select(
        F.col("f1").alias("c1"), F.col("f2").alias("c2"), F.col("n").alias("cn"), F.coalesce("component", "doc_id").alias("component"))
    out = sk.select("doc_id", "t", "n", "f1", "f2").join(
        of_class, (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")) & (F.col("n") == F.col("cn")) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), F.col("t").alias("text_hash"))
