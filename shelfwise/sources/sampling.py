"""Sample builds that are closed under links.

Bibs are drawn by a hash of their id, so a sample is repeatable and a larger share contains a smaller one.
What links reach from them belongs to the sample: volumes and items, and the other bibs of these, until
nothing is added.  Holds, loans, transactions, fields and properties follow their record, patrons follow
holds and loans; places and lookups are small and stay whole.  So each reference of the sample finds its
other end, where the source has one; transactions and holds without a record are left out.

A round joins the links that lead further with what the last round has added, in both directions, as
semi-joins; rounds are as many as the longest chain of links from a drawn bib.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import checkpoint_dir, written, written_in_turn

#: Link relations and their two ends.
LINKS = {
    "bib_record_item_record_link": ("bib_record_id", "item_record_id"),
    "bib_record_volume_record_link": ("bib_record_id", "volume_record_id"),
    "volume_record_item_record_link": ("volume_record_id", "item_record_id"),
}
#: Relations that follow a record, by the column that names it.
FOLLOW = {
    "bib_record": "record_id", "volume_record": "record_id", "item_record": "record_id",
    "bib_record_property": "bib_record_id", "item_record_property": "item_record_id", "phrase_entry": "record_id",
    "varfield": "record_id", "subfield": "record_id", "hold": "record_id", "checkout": "item_record_id",
    "circ_trans": "item_record_id",
}
#: Relations with patrons that belong to the sample.
PATRONS_OF = ("hold", "checkout", "circ_trans")
#: Rounds after which the growing set is written anew.
ROUNDS_PER_CHECKPOINT = 8


def _only(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    return df.join(ids.withColumnRenamed("id", "_sample_id"), F.col(column) == F.col("_sample_id"), "left_semi")


def reached(links: DataFrame, roots: DataFrame) -> DataFrame:
    """``id`` of the roots and of all that rows (a, b) of ``links`` connect with them; null ends connect nothing.

    Most ids are the end of links from one id only and lead no further: they are set apart once, and come with
    that id.  Rounds join what is left, which is written.
    """
    spark = roots.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        checkpoint_dir(spark)
    links = links.filter("a is not null and b is not null")
    found = added = written(roots.select("id").filter("id is not null").distinct())
    none = F.lit(None).cast(links.schema["a"].dataType)
    ends = (links.select(F.col("b").alias("id"), F.col("a").alias("head"), F.lit(False).alias("leads"))
            .union(links.select("a", none, F.lit(True))).union(found.select("id", none, F.lit(True))))
    ends = written(ends.groupBy("id").agg(F.min("head").alias("head"), F.max("head").alias("last"), F.max("leads").alias("leads"))
                   .select("id", "head", (F.col("leads") | (F.col("head") != F.col("last"))).alias("inner")))
    links = written(_only(links, "b", ends.filter("inner").select("id")).distinct())
    rounds = 0
    while True:
        near = _only(links, "a", added).select(F.col("b").alias("id")).union(
            _only(links, "b", added).select(F.col("a").alias("id"))).distinct()
        added = written(near.join(found, "id", "left_anti"))
        if added.isEmpty():
            break
        found, rounds = found.union(added), rounds + 1
        if rounds % ROUNDS_PER_CHECKPOINT == 0:
            found = written(found)
    return written(found, _only(ends.filter("not inner"), "head", found).select("id"))


def closed_sample(s: dict[str, DataFrame], share: float, seed: int = 0) -> dict[str, DataFrame]:
    """The source relations, reduced to about ``share`` of the bibs and to what belongs to them."""
    bound = f"{int(share * 16 ** 8):08x}"
    draw = F.substring(F.md5(F.concat(F.col("record_id").cast("string"), F.lit(f":{seed}"))), 1, 8)
    roots = s["bib_record"].filter(draw < bound).select(F.col("record_id").alias("id"))
    links = reduce(DataFrame.union, [s[n].select(F.col(a).alias("a"), F.col(b).alias("b")) for n, (a, b) in LINKS.items()])
    ids = reached(links, roots)
    out = dict(s)
    for name, column in FOLLOW.items():
        out[name] = _only(s[name], column, ids)
    for name, (a, b) in LINKS.items():
        out[name] = _only(_only(s[name], a, ids), b, ids)
    patrons = written_in_turn(out[n].select(F.col("patron_record_id").alias("id")).distinct() for n in PATRONS_OF).distinct()
    out["patron_record"] = _only(s["patron_record"], "record_id", patrons)
    out["record_metadata"] = _only(s["record_metadata"], "id", ids.union(patrons).distinct())
    return out
