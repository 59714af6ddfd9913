"""Items of tables whose keys exceed the bits of the adapter's item numbers."""

import datetime

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
from shelfwise.sources import adapter
from shelfwise.sources.tables import ITEM_KEYS, adapt, item_forms, ranked_items, read_driver_tables

from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of

SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
    *[T.StructField(c, T.StringType()) for c in ("l_returnflag", "l_linestatus")],
    T.StructField("l_shipdate", T.TimestampType())])


def _lineitem(spark, keys):
    """Rows (order, line, part, supplier) whose items are all in transit."""
    rest = (10.0, 100.0, 0.01, 0.01, "N", "F", datetime.datetime(1995, 3, 1))
    return spark.createDataFrame([(o, p, s, n, *rest) for o, n, p, s in keys], SCHEMA)


FAR = (1 << 21) + 5  # an order of tables some 14 times sf 0.1
PACKED = [(FAR, 1, 300_000, 20_000), (FAR, 2, 7, 3), (FAR, 2, 7, 3), (4, 3, 8, 1 << 14)]
MEET = [(5, 1, 1 << 18, 3), (5, 2, 0, 3), (5, 2, 0, 3), (4, 7, 2, 1), (6, 1, 1, 1 << 14), (6, 1, 2, 0)]
HUGE = [(1 << 40, 1, 5, 6), (1 << 40, 2, 5, 6), (3, 1, 9, 9)]
NEGATIVE = [(-4, 1, 1 << 20, 6), (3, 2, 5, 6), (3, 1, 9, 9)]


@pytest.mark.parametrize("keys", [PACKED, MEET, HUGE, NEGATIVE])
def test_items_beyond_the_bits_have_ids_of_their_own(spark, keys):
    driver = read_driver_tables(spark, SF_SMALL)
    driver["lineitem"], forms = item_forms(_lineitem(spark, keys))
    frames = adapt(spark, driver, forms)
    got = {(r["l_orderkey"], r["l_linenumber"], r["l_partkey"], r["l_suppkey"]): r["item_num"] for r in frames["li"].collect()}
    assert len(set(got.values())) == len(got) == len(set(keys))
    if keys is PACKED:
        pack = lambda o, n, p, s: ((o * 8 + n) * 262144 + p) * 16384 + s
        assert got == {k: pack(*k) for k in keys}
    else:
        assert got == {k: i for i, k in enumerate(sorted(set(keys)), 1)}
    messages = frames["varfield"].filter("varfield_type_code = 'm'").collect()
    assert {r["record_id"] for r in messages} == {n * 8 + 2 for n in got.values()}
    by_key = {(r["record_id"], r["occ_num"]): r["id"] for r in messages}
    assert len(set(by_key.values())) == len(by_key)
    assert sorted(by_key) == sorted(by_key, key=by_key.get)
    others = {r["id"] for r in frames["varfield"].filter("varfield_type_code <> 'm'").select("id").collect()}
    assert others.isdisjoint(by_key.values())


def test_keys_that_fit_keep_the_adapters_text(spark):
    lineitem = _lineitem(spark, [(5, 1, 6, 7)])
    assert item_forms(lineitem) == (lineitem, {})
    texts = dict(adapter.RELATIONS)
    assert texts["li"].count(adapter.PACK) == texts["varfield_base"].count(adapter.MESSAGE_ID) == 1


def test_ranks_do_not_depend_on_the_order_of_rows(spark):
    keys = [(i * 7919 % 1000 + (1 << 40), i % 7, i % 13, None if i == 5 else i % 11) for i in range(1000)]
    ranks = [{tuple(r[c] for c in ITEM_KEYS): r["item_num"] for r in ranked_items(_lineitem(spark, k).repartition(n)).collect()}
             for k, n in ((keys, 3), (keys[::-1], 7))]
    assert ranks[0] == ranks[1]
    whole = sorted({k for k in keys if None not in k})
    assert ranks[0] == {k: i for i, k in enumerate(whole, 1)} | {keys[5]: None}


COPIED = {"customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey", "o_custkey"],
          "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "events": ["event_id", "user_id"]}
RANK = "dense_rank() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@pytest.fixture(scope="module", params=[1 << 21, 1 << 40], ids=["packed", "ranked"])
def copies(request, tmp_path_factory):
    """Tables that hold each row twice, all keys of the copy beyond their bits; a far order needs ranks."""
    folder, con = tmp_path_factory.mktemp("copies"), duckdb.connect()
    for t in adapter.DRIVER_TABLES:
        shifted = [f"{c} + copy.range * {request.param if c in ('o_orderkey', 'l_orderkey', 'event_id') else 1 << 21} AS {c}"
                   for c in COPIED.get(t, [])]
        replaced = f"REPLACE ({', '.join(shifted)})" if shifted else ""
        con.execute(f"COPY (SELECT t.* {replaced} FROM range({2 if shifted else 1}) copy, '{SF_SMALL}/{t}.parquet' t) "
                    f"TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    forms = {adapter.MESSAGE_ID: adapter.LOW_MESSAGE_ID} | ({adapter.PACK: RANK} if request.param == 1 << 40 else {})
    return str(folder), con, forms


@pytest.mark.parametrize("name", ["Q03_most_checked_out", "R02_legacy_item_export"])
def test_queries_on_shifted_copies_match_their_oracle(spark, copies, name):
    folder, con, forms = copies
    _, used = item_forms(read_driver_tables(spark, folder)["lineitem"])
    assert (adapter.PACK in used) == (adapter.PACK in forms)
    df = entry.queries()[name](spark, folder)
    text = entry.oracle_sql()[name]
    for part, form in forms.items():
        text = text.replace(part, form)
    want = con.execute(text)
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == 100 or len(got) > 10_000
    assert rows_of(df.columns, got) == rows_of(columns, want.fetchall())
