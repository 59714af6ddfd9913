import os

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import fulltext, search
from tests.conftest import SF_SMALL

TEXTS = [(1, "The red fox, the RED fox"), (2, "red"), (3, "fox the red"), (4, None), (5, "  ...  "), (6, "a redder fox ran"), (7, "blue-red fox red")]
QUERIES = [dict(all_of=["red"]), dict(phrase=["red", "fox"]), dict(any_of=["ran", "blue"], none_of=["redder"]), dict(all_of=["the", "red"], none_of=["blue"]),
           dict(phrase=["the", "red", "fox"]), dict(all_of=["fox"], any_of=["red", "nowhere"]), dict(all_of=["Red"], phrase=["fox"], none_of=["the", "a"])]


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("query", QUERIES)
def test_index_equals_scan(spark, query):
    docs = spark.createDataFrame(TEXTS, "id long, text string")
    index, whole = fulltext.postings(docs, "id", ["text"]), fulltext.corpus(docs, "id", ["text"])
    assert rows(fulltext.search_index(index, whole, **query)) == rows(search.search(docs, "id", ["text"], **query))


def test_prefixes(spark):
    docs = spark.createDataFrame(TEXTS, "id long, text string")
    index, whole = fulltext.postings(docs, "id", ["text"]), fulltext.corpus(docs, "id", ["text"])
    ids = lambda **q: sorted(r["id"] for r in fulltext.search_index(index, whole, **q).collect())
    assert ids(all_of=["fox"], prefixes=["redd"]) == [6] and ids(all_of=["fox"], prefixes=["re", "bl"]) == [7]
    with pytest.raises(ValueError):
        ids(all_of=["fox"], prefixes=["r"])
    with pytest.raises(ValueError):
        ids(prefixes=["re"])


def test_written_index_is_pruned_to_its_terms(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = os.path.join(scratch, "index")
    fulltext.write_index(docs, "doc_id", ["text"], path)
    index, whole = fulltext.read_index(spark, path)
    query = dict(all_of=["the", "and"], any_of=["was", "it"], none_of=["en"], phrase=["of", "the"])
    found = fulltext.search_index(index, whole, **query)
    assert rows(found) == rows(search.search(docs, "doc_id", ["text"], **query)) and found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan.replace("PartitionFilters: [((", "PartitionFilters: [(") and "bucket" in plan
    read = index.filter(F.col("term") == "the").filter(F.col("bucket") == fulltext._bucket(F.lit("the")))
    assert len(read.inputFiles()) >= 1 and read.count() == index.filter("term = 'the'").count() > 0


def test_all_columns_of_a_bib(spark):
    bib = spark.createDataFrame(
        [(1, "A title", "An author", "Acme", 1999, "QA 76", ["9780306406157"], ["Rings -- History"], ["fantasy"], ["DVD"]),
         (2, None, None, None, None, None, None, None, None, None)],
        "bib_record_num long, best_title string, best_author string, publisher string, publish_year int, bib_level_callnumber string,"
        "isbn_values array<string>, indexed_subjects array<string>, genres array<string>, item_types array<string>")
    text = fulltext.bib_text(bib)
    index, whole = (f(text, "bib_record_num", fulltext.BIB_COLUMNS) for f in (fulltext.postings, fulltext.corpus))
    for word in ("title", "author", "acme", "1999", "qa", "9780306406157", "history", "fantasy", "dvd"):
        assert [r["id"] for r in fulltext.search_index(index, whole, all_of=[word]).collect()] == [1], word
