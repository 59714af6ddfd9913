"""R14 by a positional inverted index: postings beside the snapshot, read by term.

The index has a row for each (term, document): the places of the term in the document's words and the
document's length.  Rows are dealt into folders by a hash of the term's first letters, and lie in a folder
by term, so a search opens the folders of its words and prefixes only, and skips the row groups of other
terms there.  A frequent term's postings are spread over files by document.  Words, matching and BM25 are
those of ``search``: the same query gives the same rows, without reading a text.

``prefixes`` (two letters at least) must each begin a word of the document; they match but do not score.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.search import K1, B, normalised
from shelfwise.plans import storage

#: Folders of an index, and files of a folder at most (for each task that writes).
BUCKETS, SPREAD = 256, 16
#: Letters of a term that its folder depends on.
HEAD = 2

#: What a title search covers: all searchable columns of a bib.
BIB_COLUMNS = ["best_title", "best_author", "publisher", "publish_year", "bib_level_callnumber",
               "isbn_values", "indexed_subjects", "genres", "item_types"]


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(term, 1, HEAD)), F.lit(BUCKETS)).cast("int")


def _words(df: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    norm = normalised(text_cols)
    return (df.select(F.col(id_col).alias("id"), norm.alias("norm")).filter(F.col("norm") != "  ")
            .select("id", F.split(F.trim("norm"), "  ").alias("words")))


def postings(df: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """(term, id, positions, dl, bucket) of texts with unique ids."""
    words = _words(df, id_col, text_cols).select("id", F.size("words").alias("dl"), F.posexplode("words").alias("pos", "term"))
    return (words.groupBy("term", "id").agg(F.sort_array(F.collect_list("pos")).alias("positions"), F.max("dl").alias("dl"))
            .withColumn("bucket", _bucket(F.col("term"))))


def corpus(df: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """One row: the number of texts with words, and their mean length."""
    return _words(df, id_col, text_cols).agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("avgdl"))


def bib_text(bib: DataFrame) -> DataFrame:
    """Bibs with every searchable column as text."""
    lists = {f.name for f in bib.schema.fields if f.dataType.typeName() == "array"}
    return bib.select("bib_record_num", *[
        (F.array_join(c, " ") if c in lists else F.col(c).cast("string")).alias(c) for c in BIB_COLUMNS])


def write_index(df: DataFrame, id_col: str, text_cols: list[str], path: str) -> None:
    """Build the index of ``df`` under ``path``."""
    rows = postings(df, id_col, text_cols)
    (rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(SPREAD))).sortWithinPartitions("bucket", "term", "id")
     .write.partitionBy("bucket").parquet(storage.join(path, "postings")))
    corpus(df, id_col, text_cols).coalesce(1).write.parquet(storage.join(path, "corpus"))


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(storage.join(path, "postings")), spark.read.parquet(storage.join(path, "corpus"))


def search_index(index: DataFrame, whole: DataFrame, *, all_of=(), any_of=(), none_of=(), phrase=(), prefixes=()) -> DataFrame:
    """Matching (id, score) from the postings of the query's words alone; ``whole`` is the ``corpus`` row."""
    all_of, any_of, none_of, phrase, prefixes = ([w.lower() for w in ws] for ws in (all_of, any_of, none_of, phrase, prefixes))
    terms = sorted({*all_of, *any_of, *phrase})
    if not terms:
        raise ValueError("a query needs at least one positive term or a phrase")
    if any(len(p) < HEAD for p in prefixes):
        raise ValueError(f"a prefix needs {HEAD} letters")
    either = lambda conditions: reduce(lambda x, y: x | y, conditions)
    words = [*terms, *(w for w in none_of if w not in terms)]
    folders = either([F.col("bucket") == _bucket(F.lit(w)) for w in [*words, *prefixes]])
    wanted = either([F.col("term").isin(words), *[F.col("term").startswith(p) for p in prefixes]])
    places = [F.max(F.when(F.col("term") == w, F.col("positions"))).alias(f"p{i}") for i, w in enumerate(words)]
    begun = [F.max(F.col("term").startswith(p)).alias(f"b{i}") for i, p in enumerate(prefixes)]
    docs = index.filter(folders & wanted).groupBy("id").agg(F.max("dl").alias("dl"), *places, *begun)
    at = {w: F.col(f"p{i}") for i, w in enumerate(words)}
    tf = {t: F.coalesce(F.size(at[t]), F.lit(0)) for t in terms}
    needs = [*[at[w].isNotNull() for w in all_of], *[at[w].isNull() for w in none_of], *[F.col(f"b{i}") for i in range(len(prefixes))]]
    if any_of:
        needs.append(either([at[w].isNotNull() for w in any_of]))
    if phrase:
        rest = list(enumerate(phrase))[1:]
        follows = lambda p: reduce(lambda x, y: x & y, [F.array_contains(at[w], p + i) for i, w in rest], F.lit(True))
        needs.append(F.coalesce(F.exists(at[phrase[0]], follows), F.lit(False)))
    held = docs.agg(F.array(*[F.count_if(tf[t] > 0) for t in terms]).alias("df"))
    stats = whole.select(F.struct("n", "avgdl").alias("c"))
    hits = docs.filter(reduce(lambda x, y: x & y, needs, F.lit(True))).withColumn("df", held.scalar()).withColumn("c", stats.scalar())

    def part(k: int) -> Column:
        n = F.col("df")[k]
        idf = F.log(F.lit(1.0) + (F.col("c.n") - n + 0.5) / (n + 0.5))
        return idf * tf[terms[k]] * (K1 + 1) / (tf[terms[k]] + K1 * (1 - B + B * F.col("dl") / F.col("c.avgdl")))

    return hits.select("id", F.round(reduce(lambda x, y: x + y, [part(k) for k in range(len(terms))]), 6).alias("score"))


def search_documents(docs: DataFrame, **query) -> DataFrame:
    """R14 over a free-text corpus by its postings: as ``search.search_documents``."""
    hits = search_index(postings(docs, "doc_id", ["text"]), corpus(docs, "doc_id", ["text"]), **query)
    return (hits.withColumnRenamed("id", "doc_id").join(docs.select("doc_id", "lang", "source"), "doc_id")
            .orderBy(F.desc("score"), "doc_id"))


def search_bibs(bib: DataFrame, **query) -> DataFrame:
    """R14 over all nine searchable columns of the bibs, best first."""
    text = bib_text(bib)
    hits = search_index(*(f(text, "bib_record_num", BIB_COLUMNS) for f in (postings, corpus)), **query)
    return (hits.withColumnRenamed("id", "bib_record_num").join(bib.select("bib_record_num", "best_title"), "bib_record_num")
            .select("bib_record_num", "best_title", "score").orderBy(F.desc("score"), "bib_record_num"))
