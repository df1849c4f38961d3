"""Projections, filters, joins and aggregates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry import market
from textquarry.operators import joins, profile
from textquarry.plans.registry import query
from textquarry.session import table


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, n AS nb_orders FROM customer LEFT JOIN
(SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate <= '1996-12-31' GROUP BY 1) ON c_custkey = o_custkey""")
def yearly_orders_by_customer(spark: SparkSession, d: str) -> DataFrame:
    counts = market.count_declarations(table(spark, d, "orders"), "o_custkey", "o_orderdate", "1996-01-01", "1996-12-31", "nb_orders")
    parents = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return joins.left_join_on(parents, counts, "id", "o_custkey").drop("o_custkey")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def project_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where("o_totalprice > 100000").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where(F.col("o_orderstatus") == "F")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate <= '1996-12-31'")
def filter_date_range(spark: SparkSession, d: str) -> DataFrame:
    day = lambda x: F.lit(x).cast("timestamp_ntz")
    return table(spark, d, "orders").where((F.col("o_orderdate") >= day("1996-01-01")) & (F.col("o_orderdate") <= day("1996-12-31"))).select("o_orderkey", "o_orderdate")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (3, 7, 11)")
def filter_in_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where(F.col("c_nationkey").isin(3, 7, 11)).select("c_custkey", "c_nationkey")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 AND s_nationkey < 10")
def filter_expr(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").where("s_acctbal > 0 AND s_nationkey < 10").select("s_suppkey", "s_name")


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'o')")
def filter_contains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(F.contains("p_name", F.lit("o"))).select("p_partkey", "p_name")


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def dropna_any(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").dropna(how="any")


@query("SELECT doc_id, lang, nullif(quality, 0) AS good, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE nullif(quality, 0) IS NOT NULL")
def dropna_subset(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return both.select("doc_id", "lang", F.nullif("quality", F.lit(0)).alias("good"), "toxic").dropna(subset=["good"])


@query("SELECT * FROM orders WHERE o_orderkey = 7")
def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where("o_orderkey = 7")


@query("SELECT doc_id, source FROM documents WHERE doc_id > (SELECT min(doc_id) FROM documents WHERE source = 'src3')")
def resume_after_match(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.where(F.col("doc_id") > docs.where("source = 'src3'").agg(F.min("doc_id")).scalar())


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def head_n(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_mktsegment", "c_nationkey").dropDuplicates()


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderpriority").distinct()


@query("""SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL BY NAME SELECT s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier""")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    b = table(spark, d, "supplier").selectExpr("s_name AS name", "s_nationkey AS nation", "s_acctbal AS balance")
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS id, c_custkey, c_name FROM customer")
def row_id(spark: SparkSession, d: str) -> DataFrame:
    return profile.with_row_id(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


_PARENT = "SELECT c_custkey AS file_name, c_name AS name, c_nationkey AS nation FROM customer"


@query(f"SELECT p.*, n, total FROM ({_PARENT}) p LEFT JOIN (SELECT o_custkey AS file_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) USING (file_name)")
def left_join_new_cols(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "customer").selectExpr("c_custkey AS file_name", "c_name AS name", "c_nationkey AS nation")
    found = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("file_name")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.lit("x").alias("name"))
    return joins.left_join_new_columns(parents, found, "file_name")


@query("SELECT c_nationkey AS k, c_name AS name_x, c_acctbal AS bal_x, s_name AS name_y, s_acctbal AS bal_y FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey AND s_nationkey < 3")
def left_join_suffix(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").selectExpr("c_nationkey AS k", "c_name AS name", "c_acctbal AS bal")
    b = table(spark, d, "supplier").where("s_nationkey < 3").selectExpr("s_nationkey AS k", "s_name AS name", "s_acctbal AS bal")
    return joins.left_join_suffixed(a, b, "k")


@query("SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_join_diff_keys(spark: SparkSession, d: str) -> DataFrame:
    return joins.left_join_on(table(spark, d, "customer").select("c_custkey", "c_nationkey"), table(spark, d, "nation").select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey")


@query("SELECT c_custkey AS id, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_join_entities(spark: SparkSession, d: str) -> DataFrame:
    children = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    return joins.semi_join(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment"), children)


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join_files(spark: SparkSession, d: str) -> DataFrame:
    return joins.semi_join(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


_TEXTS = "SELECT sha256(text) AS hash, doc_id FROM documents"


@query(f"SELECT hash, min(doc_id) AS file_name FROM ({_TEXTS}) WHERE hash NOT IN (SELECT hash FROM ({_TEXTS}) WHERE doc_id IN (SELECT doc_id FROM labels)) GROUP BY hash")
def anti_join_hash(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documents").select(F.sha2("text", 256).alias("hash"), F.col("doc_id").alias("file_name"))
    return joins.unprocessed(texts, joins.semi_join(texts, table(spark, d, "labels").select(F.col("doc_id").alias("file_name")), "file_name"))


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT c_custkey, 'seen again' AS c_name, 0.0 AS c_acctbal FROM customer WHERE c_nationkey = 3""")
def upsert_entities(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer")
    again = rows.where("c_nationkey = 3").select("c_custkey", F.lit("seen again").alias("c_name"), F.lit(0.0).alias("c_acctbal"))
    return joins.upsert(rows.select("c_custkey", "c_name", "c_acctbal"), again, "c_custkey")


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1")
def group_size(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where("o_custkey IS NOT NULL").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("SELECT lang, count(doc_id) AS doc_id, count(quality) AS quality, count(toxic) AS toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE lang IS NOT NULL GROUP BY lang")
def group_count_all(spark: SparkSession, d: str) -> DataFrame:
    return profile.group_counts(table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left"), "lang")


@query("SELECT c_mktsegment AS topic, count(*) AS count FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def value_counts_topic(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(table(spark, d, "customer"), "c_mktsegment").withColumnsRenamed({"c_mktsegment": "topic"})


@query("SELECT event_type, count(*) AS count, round(100.0 * count(*) / (SELECT count(event_type) FROM events), 1)::DOUBLE AS percent FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_share(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_shares(table(spark, d, "events"), "event_type")


@query("SELECT count_if(lang = 'en')::BIGINT AS en, count_if(lang = 'fr')::BIGINT AS fr, count_if(source = 'src1')::BIGINT AS src1, count(*) AS total FROM documents")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg(F.count_if(F.col("lang") == "en").alias("en"), F.count_if(F.col("lang") == "fr").alias("fr"), F.count_if(F.col("source") == "src1").alias("src1"), F.count("*").alias("total"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def events_per_month(spark: SparkSession, d: str) -> DataFrame:
    from textquarry.functions import dates

    rows = table(spark, d, "orders").select(F.date_trunc("month", "o_orderdate").alias("day")).dropna()
    return rows.groupBy(dates.month(F.col("day")).alias("month")).agg(F.count("*").alias("n")).orderBy("month")


@query("""SELECT least(floor((l_extendedprice - low) / ((high - low) / 10))::INT + 1, 10) AS bin, count(*) AS count
FROM lineitem, (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem) GROUP BY 1""")
def histogram10(spark: SparkSession, d: str) -> DataFrame:
    return profile.histogram(table(spark, d, "lineitem"), "l_extendedprice")


def _per_column(columns: list[str], source: str, facts: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {facts.format(c=c)} FROM {source}" for c in columns)


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(_per_column(_NUMBERS, "lineitem", "count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max"))
def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(*_NUMBERS)
    return _rounded(profile.describe(rows), "mean", "std", "q25", "q50", "q75")


@query(_per_column(["doc_id", "quality", "toxic"], "documents LEFT JOIN labels USING (doc_id)", "count_if({c} IS NULL)::BIGINT AS nulls, count({c}) AS non_nulls"))
def null_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.null_counts(table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left"))


_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i:]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a, b in _PAIRS))
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return profile.correlations(table(spark, d, "lineitem"), _NUMBERS)


@query("WITH q AS (" + _per_column(_NUMBERS, "lineitem", "quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3") + "), v AS (" + _per_column(_NUMBERS, "lineitem", "{c} AS value")
       + """) SELECT q."column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(q1 - 1.5 * (q3 - q1), 4) AS low, round(q3 + 1.5 * (q3 - q1), 4) AS high,
count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))::BIGINT AS outliers FROM q JOIN v USING ("column") GROUP BY ALL""")  # fmt: skip
def iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(profile.iqr_outliers(table(spark, d, "lineitem"), _NUMBERS), "q1", "q3", "low", "high")


@query("SELECT count(p_name) AS n, count(DISTINCT p_name) AS \"distinct\", round(count(DISTINCT p_name) / count(p_name), 6) AS ratio FROM part")
def uniqueness_ratio(spark: SparkSession, d: str) -> DataFrame:
    return profile.uniqueness_ratio(table(spark, d, "part"), "p_name")


@query(_per_column(["c_custkey", "c_name", "c_mktsegment"], "customer", "count(*) AS n, count_if({c} IS NULL)::BIGINT AS nulls, count(DISTINCT {c}) AS \"distinct\", typeof(any_value({c})) = 'VARCHAR' AND count_if({c} IS NULL) = 0 AS all_text"))
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.column_profile(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in ("orders", "documents", "pages")))
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = [table(spark, d, t).agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t in ("orders", "documents", "pages")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


#: Share of people who choose a kind of concert. Fixed values.
CONCERTS = (("Pop, rock, chanson", 0.25), ("Jazz, blues, soul, funk et genres assimilés", 0.034), ("Musique classique et contemporaine", 0.041), ("Musique électronique", 0.066), ("Musique du monde et traditionnelle", 0.021), ("Rap, hip-hop et genres assimilés", 0.056), ("Opéra et théâtre lyrique", 0.018))
TICKETS = 2.97e6
_MARKET = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{k}', {p}::DOUBLE)" for i, (k, p) in enumerate(CONCERTS)) + ") t(id_concert_type, concert_type, choosing_probability)"


def _market(spark: SparkSession) -> DataFrame:
    rows = [(i, k, p) for i, (k, p) in enumerate(CONCERTS)]
    return spark.createDataFrame(rows, "id_concert_type int, concert_type string, choosing_probability double").withColumn("tickets", F.round(F.col("choosing_probability") * TICKETS, 2))


@query(f"SELECT *, round(choosing_probability * 2970000, 2) AS tickets FROM ({_MARKET})")
def market_size(spark: SparkSession, d: str) -> DataFrame:
    return _market(spark)


@query(f"SELECT round(sum(choosing_probability), 6) AS probability, round(sum(round(choosing_probability * 2970000, 2)), 2) AS tickets FROM ({_MARKET})")
def market_size_total(spark: SparkSession, d: str) -> DataFrame:
    return _market(spark).agg(F.round(F.sum("choosing_probability"), 6).alias("probability"), F.round(F.sum("tickets"), 2).alias("tickets"))


_NAMES = "SELECT DISTINCT p_name AS b FROM part"
_LEFT = f"SELECT array_to_string(list_reverse(string_split(b, ' ')), ' ') AS a FROM ({_NAMES}) UNION SELECT b || 's' FROM ({_NAMES}) UNION SELECT 'no such ' || b FROM ({_NAMES})"
_SORTED = "array_to_string(list_sort(string_split(trim(regexp_replace(lower({c}), '[^\\pL\\pN_]+', ' ', 'g')), ' ')), ' ')"
_FUZZY = f"""WITH RECURSIVE l AS (SELECT a, {_SORTED.format(c="a")} AS x FROM ({_LEFT})), r AS (SELECT b, {_SORTED.format(c="b")} AS y FROM ({_NAMES})),
t AS (SELECT row_number() OVER () AS id, a, b, x, y FROM l, r WHERE 2 * least(length(x), length(y)) >= 0.945 * (length(x) + length(y))),
s(id, i, j, prev, cur) AS (SELECT id, 1::BIGINT, 1::BIGINT, list_transform(range(0, length(y) + 1), lambda z: 0::BIGINT), [0::BIGINT] FROM t
UNION ALL SELECT id, CASE WHEN j = length(y) THEN i + 1 ELSE i END, CASE WHEN j = length(y) THEN 1 ELSE j + 1 END,
CASE WHEN j = length(y) THEN list_append(cur, v) ELSE prev END, CASE WHEN j = length(y) THEN [0::BIGINT] ELSE list_append(cur, v) END
FROM (SELECT s.*, x, y, CASE WHEN substr(x, i, 1) = substr(y, j, 1) THEN prev[j] + 1 ELSE greatest(prev[j + 1], cur[j]) END AS v FROM s JOIN t USING (id) WHERE i <= length(x))),
g AS (SELECT a, b, round(100 * 2 * prev[length(y) + 1] / (length(x) + length(y)))::INT AS score FROM s JOIN t USING (id) WHERE i = length(x) + 1),
best AS (SELECT a, b AS "match", score FROM g WHERE score >= 95 QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) = 1)
"""


def _fuzzy_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    names = table(spark, d, "part").select(F.col("p_name").alias("b")).distinct()
    left = names.select(F.array_join(F.reverse(F.split("b", " ")), " ").alias("a")).union(names.select(F.concat("b", F.lit("s")))).union(names.select(F.concat(F.lit("no such "), "b"))).distinct()
    return left, names


@query(_FUZZY + "SELECT l.a, \"match\", score FROM l LEFT JOIN best USING (a)")
def fuzzy_best_match(spark: SparkSession, d: str) -> DataFrame:
    return joins.fuzzy_best(*_fuzzy_sides(spark, d), "a", "b")


@query(_FUZZY + "SELECT l.a, \"match\" AS name_match, n FROM l LEFT JOIN best USING (a) LEFT JOIN (SELECT p_name AS \"match\", count(*) AS n FROM part GROUP BY 1) USING (\"match\")")
def fuzzy_join(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "part").groupBy(F.col("p_name").alias("b")).agg(F.count("*").alias("n"))
    return joins.fuzzy_left_join(_fuzzy_sides(spark, d)[0], counts, "a", "b")


@query(_FUZZY + "SELECT a, \"match\" AS name_match FROM best")
def fuzzy_join_matched(spark: SparkSession, d: str) -> DataFrame:
    return joins.fuzzy_left_join(*_fuzzy_sides(spark, d), "a", "b").where("name_match IS NOT NULL")
