"""Every query that is registered outside the optional subpackage against its SQL, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from cairnspark.plans.catalog import ORACLE_SQL, QUERIES
from cairnspark.plans.graph import statements

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in frame.collect())
    result = duck.sql(ORACLE_SQL[name])
    names = result.columns
    assert sorted(names) == columns
    want = sorted(tuple(str(dict(zip(names, r, strict=True))[c]) for c in columns) for r in result.fetchall())
    assert got == want


def test_provenance_has_the_evidence_of_all_sources(spark, tmp_path):
    for t in TABLES:
        if t != "documents":
            (tmp_path / f"{t}.parquet").symlink_to(f"{DATA}/{t}.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    source = F.when(F.col("doc_id") == 2, F.lit(None)).when(F.col("doc_id") == 3, "archive").otherwise(F.col("source"))
    docs.withColumn("source", source).write.parquet(str(tmp_path / "documents.parquet"))
    named = {2: None, 3: "archive"}
    said = statements(spark, DATA).filter("evidence_id IS NOT NULL").groupBy("evidence_id").count().collect()
    got = QUERIES["provenance_chain"](spark, str(tmp_path)).groupBy("source").count().collect()
    assert len(said) == 10 and {r["source"]: r["count"] for r in got} == {named.get(r["evidence_id"], f"src{r['evidence_id']}"): r["count"] for r in said}
