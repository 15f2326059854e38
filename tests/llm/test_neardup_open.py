"""op3: a turn passes on the members that are not yet connected with their hub, no others."""

from loomlog.llm import neardup


def test_turns_pass_on_open_members_only(spark, monkeypatch):
    hub = set(range(0, 2000, 2))
    own = {k: hub - {2 * j for j in range(40)} | {4000 + 2 * k} for k in range(1, 61)}    # all lack the same 40
    met = []
    for k, s in own.items():
        # every fourth is given as linked with the hub
        met.append((0, k, len(hub & s), len(hub), len(s), k % 4 == 0, sorted([e for e in s - hub] + [e | 1 for e in hub - s])))
    near = spark.createDataFrame(met, "hub long, id long, both long, n_hub long, n_id long, link boolean, apart array<long>")
    passed, real = [], neardup._through_centres

    def spy(items, *more):
        passed.append(items.select("id", "link").distinct().collect())
        return real(items, *more)

    monkeypatch.setattr(neardup, "_through_centres", spy)
    links = neardup._between(near, 85).collect()
    assert passed and not any(r["link"] for rows in passed for r in rows)
    assert {r["b"] for r in links} >= {k for k in own if k % 4}
