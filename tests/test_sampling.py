"""Closed samples, by a breadth-first search over the links."""

from pyspark.sql import functions as F

from shelfwise.plans import context
from shelfwise.sources import sampling

SF = "/root/testdata/sf0.001"


def test_reached_follows_chains_both_ways(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(50, 51), (7, None), (None, 51), (0, 1)], "a long, b long")
    roots = spark.createDataFrame([(5,), (5,), (None,), (99,)], "id long")
    assert sorted(r["id"] for r in sampling.reached(links, roots).collect()) == [*range(13), 99]
    assert sampling.reached(links, roots.limit(0)).collect() == []


def test_a_sample_is_closed_and_repeatable(spark):
    s = context.sources(spark, SF)
    a = sampling.closed_sample(s, 0.1)
    column = lambda t, c: {r[0] for r in t.select(c).distinct().collect()}
    bibs, items, volumes = (column(a[n], "record_id") for n in ("bib_record", "item_record", "volume_record"))
    assert 0 < len(bibs) < s["bib_record"].count()
    ids = bibs | items | volumes
    # every link of a sampled record is there, with both ends
    for name, (x, y) in sampling.LINKS.items():
        every = {tuple(r) for r in s[name].select(x, y).collect()}
        held = {tuple(r) for r in a[name].select(x, y).collect()}
        known = {p for n in ("bib_record", "item_record", "volume_record") for p in column(s[n], "record_id")}
        assert held == {p for p in every if p[0] in ids or p[1] in ids}
        assert all((e in ids) or (e not in known) for p in held for e in p), name
    assert column(a["hold"], "record_id") <= ids and column(a["circ_trans"], "item_record_id") <= items
    patrons = column(a["hold"], "patron_record_id") & column(s["patron_record"], "record_id")
    assert patrons <= column(a["patron_record"], "record_id")
    # a larger share contains a smaller one, and another seed draws others
    assert bibs <= column(sampling.closed_sample(s, 0.3)["bib_record"], "record_id")
    assert bibs != column(sampling.closed_sample(s, 0.1, seed=1)["bib_record"], "record_id")
