"""Each registered query against its SQL, on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from textquarry.plans import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(relation):
    columns = sorted(relation.columns)
    return columns, sorted(map(repr, relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, sf_dir, tmp_path, name):
    registry.QUERIES[name](spark, sf_dir).write.parquet(f"{tmp_path}/out")
    assert rows(duck.sql(f"SELECT * FROM '{tmp_path}/out/*.parquet'")) == rows(duck.sql(registry.ORACLES[name]))


#: References that are cut off, as where the tables' titles end; the SQL decodes only those with a semicolon.
CUT = ["<h1>a &amp;&amp</h1><p>&copy b&quot</p>", "<h1>&am</h1>&ampx; &amp;lt; &#39;", "<h1>&amp;lt &lt</h1>", "<h1> &quot;&quot </h1>&a", "<p>&eacute;&eacute</p>", None]


@pytest.mark.parametrize("name", ["html_first_match", "html_to_text", "site_text_concat"])
def test_cut_references_match_sql(spark, tmp_path, name):
    spark.createDataFrame([(i, f"http://s{i % 2}.example/{i}", page) for i, page in enumerate(CUT)], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    registry.QUERIES[name](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert rows(con.sql(f"SELECT * FROM '{tmp_path}/out/*.parquet'")) == rows(con.sql(registry.ORACLES[name]))


def test_only_clusters_have_no_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"transform_entry"}


def test_transform_entry(spark, sf_dir):
    """Topics have no SQL: every document has one of four, with that topic's count and label."""
    rows = registry.QUERIES["transform_entry"](spark, sf_dir).collect()
    assert sorted(r["id"] for r in rows) == sorted(r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    sizes = Counter(r["description_topic"] for r in rows)
    assert set(sizes) <= {0, 1, 2, 3} and len(sizes) > 1
    assert all(r["description_topic_count"] == sizes[r["description_topic"]] and r["description_topic_label"].startswith(f"{r['description_topic']}_") for r in rows)
