"""Case/vote log analysis.

Text format: ``A,<id>,1,"<title>","<url>"`` attribute lines, ``C,"<id>",<id>``
case lines each followed by ``V,<attr id>,1`` vote lines; other header
letters (I, T, N) are ignored.  Records come either from the general
grouping (sources.records, S7) or from chunks cut at ``\\nC`` (S6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.functions.scalar import regex_all_ints
from loomlog.sources import records, text

# Fixed value: vote pattern of the format (attribute id in group 1).
VOTE_REGEX = r"V,(\d*),\d*"


def int_field(text, index: int, sep: str = ",") -> F.Column:
    """The ``index``-th (0-based) ``sep``-separated field as int; null when
    the field is missing or not a number (no error under ANSI mode, so one
    malformed line cannot fail a large job)."""
    return F.get(F.split(text, sep), index).try_cast("int")


def line_kind(value: F.Column) -> F.Column:
    """Record letter: the text before the first comma."""
    return F.split(value, ",", 2).getItem(0)


def parse_attributes(lines: DataFrame, column: str = "value") -> DataFrame:
    """``A`` lines → (id int, title, url); quoted titles may hold
    commas and quotes (CSV rules), unlike a plain split."""
    a = lines.where(line_kind(F.col(column)) == "A")
    # CSV rules: a quote inside a quoted title is doubled.
    parsed = F.from_csv(F.col(column), S.ATTRIBUTE_LINE_DDL, {"escape": '"'})
    return a.select(parsed.alias("r")).select(
        F.col("r.id").alias("id"), F.col("r.title").alias("title"), F.col("r.url").alias("url"))


def _votes_of(lines: F.Column) -> F.Column:
    """``V`` lines of a list → their attribute ids, in order."""
    return F.transform(F.filter(lines, lambda v: v.startswith("V,")),
                       lambda v: int_field(v, 1))


def cases_from_records(records: DataFrame) -> DataFrame:
    """Records (header + lines) whose header is a ``C`` line →
    (case_id int, attr_ids array<int>); no votes → empty array."""
    c = records.where(line_kind(F.col("header")) == "C")
    followers = F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))
    return c.select(int_field(F.col("header"), 2).alias("case_id"),
                    _votes_of(followers).alias("attr_ids"))


def cases_from_record_text(records: DataFrame, column: str = "record_text") -> DataFrame:
    """The serialised form ``C,"id",id,{V,a,1;V,b,1}`` → case id and all
    regex matches of the vote pattern."""
    c = records.where(line_kind(F.col(column)) == "C")
    head = F.split(F.col(column), r"\{").getItem(0)
    return c.select(int_field(head, 2).alias("case_id"),
                    regex_all_ints(F.col(column), VOTE_REGEX).alias("attr_ids"))


def chunk_lines(chunks: DataFrame) -> DataFrame:
    """S6 helper: chunks cut at ``\\nC`` → (is_case, lines).  A chunk that
    is not the first of its file lost its leading ``C`` to the delimiter
    and starts with ``,``; the first chunk of a file is a case only if the
    file begins with a ``C`` line."""
    text = F.col("value")
    restored = F.when(text.startswith(","), F.concat(F.lit("C"), text)).otherwise(text)
    lines = F.filter(F.split(restored, "\n"), lambda l: l != "")
    return chunks.select(lines.alias("lines")).select(
        (line_kind(F.element_at("lines", 1)) == "C").alias("is_case"), "lines")


def cases_from_chunks(chunks: DataFrame) -> DataFrame:
    """Cases from ``\\nC`` chunks (no shuffle: each chunk is one case and
    whatever comes before the next one; its votes end where another record begins)."""
    c = chunk_lines(chunks).where("is_case")
    header = F.element_at("lines", 1)
    followers = F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))
    begins = F.transform(followers, lambda l: ~l.startswith("V,") & records.is_header(l, S.CASE_VOTE_HEADER_REGEX))
    stop = F.array_position(begins, True).cast("int")
    own = F.when(stop > 0, F.slice(followers, 1, F.greatest(stop - 1, F.lit(0)))).otherwise(followers)
    return c.select(int_field(header, 2).alias("case_id"), _votes_of(own).alias("attr_ids"))


#: A file that is larger is not read by delimiter: a stretch of it without a case would be one row.
HEAD_BYTES = 64 * 1024 * 1024


def case_lines(lines: DataFrame) -> DataFrame:
    """Lines a case can be made of: headers, which end cases too, and votes."""
    value = F.col("value")
    return lines.where(value.startswith("V,") | records.is_header(value, S.CASE_VOTE_HEADER_REGEX))


def cases_by_delimiter(spark: SparkSession, path: str | list[str], head_bytes: int = HEAD_BYTES) -> DataFrame:
    """Cases (case_id, attr_ids) without a shuffle of the text.

    Files of at most ``head_bytes`` are cut at ``\\nC``, so no row is longer than
    that.  Larger ones are read line by line and grouped by S7, headers and
    votes only: heads, tails and any stretch without a case stay in the scan, and no
    row holds more than one case or one line.  Both ways give the same cases
    (tested); which files go which way is a filter on the scans' file sizes."""
    size = F.col("_metadata.file_size")
    if not text.file_sizes(spark, path).where(F.col("length") > head_bytes).limit(1).count():
        return cases_from_chunks(text.read_chunks(spark, path, "\nC"))
    small = cases_from_chunks(text.read_chunks(spark, path, "\nC").where(size <= head_bytes).select("value"))
    lines = case_lines(records.positioned_lines(spark, path, larger_than=head_bytes))
    return small.unionByName(cases_from_records(records.group_lines(lines, S.CASE_VOTE_HEADER_REGEX)))


def attribute_lines_from_chunks(chunks: DataFrame) -> DataFrame:
    """``A`` lines wherever they occur (first chunk, or after votes), ready
    for ``parse_attributes``."""
    lines = chunk_lines(chunks).select(F.explode("lines").alias("value"))
    return lines.where(line_kind(F.col("value")) == "A")


def votes_exploded(cases: DataFrame) -> DataFrame:
    """One row per vote (case_id, attr_id)."""
    return cases.select("case_id", F.explode("attr_ids").alias("attr_id"))


def votes_per_attribute(cases: DataFrame) -> DataFrame:
    """Votes per attribute id (explode + partial/final aggregate)."""
    return votes_exploded(cases).groupBy("attr_id").agg(F.count(F.lit(1)).alias("cnt"))


def active_cases(cases: DataFrame) -> DataFrame:
    """Cases with at least one vote, with size and last vote."""
    return cases.where(F.size("attr_ids") > 0).select(
        "case_id", F.size("attr_ids").cast("bigint").alias("n_votes"),
        F.element_at("attr_ids", -1).alias("last_vote"))


def attribute_votes(attributes: DataFrame, cases: DataFrame | None = None,
                    vote_counts: DataFrame | None = None) -> DataFrame:
    """Every attribute with its vote count, null when it has none.
    Counts come from ``cases`` or ready-made ``vote_counts`` (attr_id, cnt)."""
    counts = vote_counts if vote_counts is not None else votes_per_attribute(cases)
    return attributes.join(counts, attributes["id"] == counts["attr_id"], "left") \
        .select("id", "title", "url", "cnt")


def attribute_votes_ranked(attributes: DataFrame, cases: DataFrame | None = None, k: int = 20,
                           vote_counts: DataFrame | None = None) -> DataFrame:
    """Attributes by vote count (missing = 0) descending, id
    ascending; the first ``k``."""
    ranked = attribute_votes(attributes, cases, vote_counts).select(
        "id", "title", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"))
    return ranked.orderBy(F.desc("cnt"), F.asc("id")).limit(k)


def case_summary(cases: DataFrame) -> DataFrame:
    """Comparable flat form of cases: id, number of votes, votes as text in
    file order."""
    return cases.select("case_id", F.size("attr_ids").cast("bigint").alias("n_votes"),
                        F.array_join(F.transform("attr_ids", lambda x: x.cast("string")), ",")
                        .alias("votes"))
