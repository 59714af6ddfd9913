"""Full-text search (R14) as DataFrame operations, no index engine.

A query is structured, not parsed: ``all_of`` terms must all occur, ``any_of``
needs one of them, ``none_of`` excludes, ``phrase`` requires consecutive words.
Each text is normalised once into words set off by spaces, and its length, the
frequency of each query term and the matches are read off that string with
built-in string functions, so no word ever becomes a row or an array element.
Ranking is Okapi BM25 over the positive terms: one pass gathers the number of
documents, their mean length and the document frequencies, a second filters
and scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
K1 = 1.2
B = 0.75


def normalised(text_cols: list[str]) -> Column:
    """The lower-case words of the concatenated text columns, each between two spaces of its own."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), TOKEN_SPLIT, "  ")), F.lit(" "))


def _occurrences(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def search(df: DataFrame, id_col: str, text_cols: list[str], *, all_of=(), any_of=(), none_of=(), phrase=()) -> DataFrame:
    """Matching (id, score): BM25 over the positive query terms; ids are unique."""
    if not (all_of or any_of or phrase):
        raise ValueError("a query needs at least one positive term or a phrase")
    all_of, any_of, none_of, phrase = ([w.lower() for w in ws] for ws in (all_of, any_of, none_of, phrase))
    terms = sorted({*all_of, *any_of, *phrase})
    norm = F.col("norm")
    has = lambda words: F.instr(norm, " " + "  ".join(words) + " ") > 0
    docs = df.select(F.col(id_col).alias("id"), normalised(text_cols).alias("norm")).filter(F.col("norm") != "  ")
    docs = docs.select(
        "id", (_occurrences(norm, "  ") + 1).alias("dl"),
        F.array(*[_occurrences(norm, f" {t} ") for t in terms]).alias("tf"),
        reduce(lambda x, y: x & y, [F.lit(True), *[has([t]) for t in all_of], *[~has([t]) for t in none_of],
                                    *([reduce(lambda x, y: x | y, [has([t]) for t in any_of])] if any_of else []),
                                    *([has(phrase)] if phrase else [])]).alias("hit"))
    corpus = docs.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"),
                               F.array(*[F.count_if(F.col("tf")[k] > 0) for k in range(len(terms))]).alias("df")).alias("c"))
    hits = docs.filter("hit").withColumn("c", corpus.scalar())

    def part(k: int) -> Column:
        tf, df_t = F.col("tf")[k], F.col("c.df")[k]
        idf = F.log(F.lit(1.0) + (F.col("c.n") - df_t + 0.5) / (df_t + 0.5))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("c.avgdl")))

    return hits.select("id", F.round(reduce(lambda x, y: x + y, [part(k) for k in range(len(terms))]), 6).alias("score"))


def search_bibs(t, **query) -> DataFrame:
    """Bibs matching a query on title, author and subjects, with rank and total checkouts."""
    bib = t["bib"].select("bib_record_num", "best_title", "best_author",
                          F.array_join(F.coalesce("indexed_subjects", F.array()), " ").alias("subjects"))
    hits = search(bib, "bib_record_num", ["best_title", "best_author", "subjects"], **query)
    totals = t["item"].groupBy("bib_record_num").agg(F.sum("checkout_total").alias("total_checkouts"))
    return (hits.withColumnRenamed("id", "bib_record_num").join(bib, "bib_record_num")
            .join(totals, "bib_record_num", "left")
            .select("bib_record_num", "best_title", "best_author", "score", "total_checkouts")
            .orderBy(F.desc("score"), "bib_record_num"))


def search_documents(docs: DataFrame, **query) -> DataFrame:
    """R14 over a free-text corpus (whole documents)."""
    hits = search(docs, "doc_id", ["text"], **query)
    return (hits.withColumnRenamed("id", "doc_id").join(docs.select("doc_id", "lang", "source"), "doc_id")
            .orderBy(F.desc("score"), "doc_id"))
