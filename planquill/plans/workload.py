"""The workload: a query for every kind of plan node that the log can hold.

Each is declared with DataFrame operations and left to Catalyst; hints stand only where a query exists
to show one join strategy. Sums of money go through decimals, so that they do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planquill.operators import upsert
from planquill.operators.recursion import reachable
from planquill.sources import logfile
from planquill.sources.external import external, records

from .registry import Tables, query

c = F.col


def money(x: str | Column) -> Column:
    """An order-independent sum of amounts, as double."""
    return F.sum((c(x) if isinstance(x, str) else x).cast("decimal(18,2)")).cast("double")


def big(x: Column) -> Column:
    return x.cast("long")


MONEY = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


# Result, Values, Function and ProjectSet ---------------------------------------------------------


@query("SELECT 1 AS one WHERE true")
def w_result_const(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT 1 AS one WHERE true")


@query("SELECT o_orderkey FROM orders WHERE 1 = 0")
def w_result_false_filter(t: Tables) -> DataFrame:
    return t.orders.where(F.lit(1) == 0).select("o_orderkey")


@query("SELECT id, name FROM (VALUES (1, 'a'), (2, 'b'), (3, 'c')) v(id, name) WHERE id > 1")
def w_values(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT id, name FROM VALUES (1, 'a'), (2, 'b'), (3, 'c') AS v(id, name) WHERE id > 1")


@query("SELECT CAST(g AS BIGINT) AS g, CAST(g * g AS BIGINT) AS square FROM generate_series(1, 1000) s(g) WHERE g % 7 = 0")
def w_generate_series(t: Tables) -> DataFrame:
    return t.spark.range(1, 1001).where("id % 7 = 0").select(c("id").alias("g"), (c("id") * c("id")).alias("square"))


@query("SELECT r_regionkey, CAST(unnest(generate_series(1, 1 + r_regionkey)) AS INTEGER) AS step FROM region")
def w_project_set(t: Tables) -> DataFrame:
    return t.region.select("r_regionkey", F.explode(F.sequence(F.lit(1), 1 + c("r_regionkey"))).alias("step"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'click'")
def w_table_function_json(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'click'").select("event_id", F.inline(F.array(F.from_json("props", "k long"))).alias("k"))


@query("SELECT r_name, CAST(unnest([r_regionkey, r_regionkey * 10]) AS INTEGER) AS x FROM region")
def w_table_function_xml(t: Tables) -> DataFrame:
    """Rows of an XML document built from each region."""
    xml = F.concat(F.lit("<r><x>"), c("r_regionkey").cast("string"), F.lit("</x><x>"), (c("r_regionkey") * 10).cast("string"), F.lit("</x></r>"))
    return t.region.select("r_name", F.explode(F.xpath(xml, F.lit("r/x/text()"))).alias("x")).withColumn("x", c("x").cast("int"))


# Scans -------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus <> 'F'")
def w_scan_seq_filter(t: Tables) -> DataFrame:
    return t.orders.where("o_totalprice > 300000 AND o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey = 42")
def w_scan_point(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey = 42").select("c_custkey", "c_acctbal")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 100 AND 900")
def w_scan_range(t: Tables) -> DataFrame:
    return t.orders.where(c("o_orderkey").between(100, 900)).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey < 500")
def w_scan_covering(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey < 500").select("o_orderkey")


@query("SELECT count(*) AS n FROM lineitem WHERE l_partkey < 40 OR l_suppkey = 3")
def w_scan_bitmap_or(t: Tables) -> DataFrame:
    return t.lineitem.where("l_partkey < 40 OR l_suppkey = 3").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM lineitem WHERE l_partkey < 400 AND l_suppkey < 20")
def w_scan_bitmap_and(t: Tables) -> DataFrame:
    return t.lineitem.where("l_partkey < 400 AND l_suppkey < 20").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, n_name FROM (SELECT *, row_number() OVER () - 1 AS place FROM nation) WHERE place = 3")
def w_scan_row_id(t: Tables) -> DataFrame:
    """Rows by their place in the file."""
    return t.nation.where(c("_metadata.row_index") == 3).select("n_nationkey", "n_name")


@query("SELECT n_nationkey, n_name FROM (SELECT *, row_number() OVER () - 1 AS place FROM nation) WHERE place BETWEEN 5 AND 9")
def w_scan_row_range(t: Tables) -> DataFrame:
    return t.nation.where(c("_metadata.row_index").between(5, 9)).select("n_nationkey", "n_name")


@query("SELECT count(*) AS n FROM orders TABLESAMPLE 100 PERCENT")
def w_sample_full(t: Tables) -> DataFrame:
    return t.orders.sample(fraction=1.0, seed=1).agg(F.count("*").alias("n"))


@query()
def w_sample_pct(t: Tables) -> DataFrame:
    return t.orders.sample(fraction=0.1, seed=7).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 2) < '1a'")
def w_sample_hash(t: Tables) -> DataFrame:
    return t.orders.where(F.substring(F.md5(c("o_orderkey").cast("string")), 1, 2) < "1a").select("o_orderkey")


@query("SELECT s.o_custkey, s.spent FROM (SELECT o_custkey, " + MONEY.format("o_totalprice") + " AS spent FROM orders GROUP BY o_custkey) s WHERE s.spent > 1000000")
def w_subquery_scan(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(money("o_totalprice").alias("spent")).where("spent > 1000000")


@query("WITH big AS MATERIALIZED (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) SELECT a.n, count(*) AS customers FROM big a JOIN big b USING (o_custkey) GROUP BY a.n")
def w_cte_materialized(t: Tables) -> DataFrame:
    big_ = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return big_.join(big_.select("o_custkey"), "o_custkey").groupBy("n").agg(F.count("*").alias("customers"))


@query("WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 90) SELECT CAST(sum(n) AS BIGINT) AS total FROM r")
def w_recursive_sum(t: Tables) -> DataFrame:
    return t.spark.sql("WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 90) SELECT sum(n) AS total FROM r")


@query(
    """WITH RECURSIVE up AS (SELECT n_nationkey AS node, CASE WHEN n_nationkey = 0 THEN NULL ELSE n_nationkey // 2 END AS parent FROM nation),
    r(node, top, depth) AS (SELECT node, node, 0 FROM up WHERE parent IS NULL
      UNION ALL SELECT up.node, r.top, r.depth + 1 FROM up JOIN r ON up.parent = r.node AND up.node <> r.node)
    SELECT node, depth FROM r"""
)
def w_recursive_hierarchy(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("planquill_nation")
    return t.spark.sql(
        """WITH RECURSIVE r(node, depth) AS (
             SELECT n_nationkey, 0 FROM planquill_nation WHERE n_nationkey = 0
             UNION ALL SELECT n.n_nationkey, r.depth + 1 FROM planquill_nation n JOIN r
               ON n.n_nationkey div 2 = r.node AND n.n_nationkey <> r.node)
           SELECT node, depth FROM r"""
    )


@query(
    """WITH RECURSIVE e AS (SELECT l_partkey AS a, -l_suppkey AS b FROM lineitem UNION SELECT -l_suppkey, l_partkey FROM lineitem),
    r(node) AS (SELECT min(l_partkey) FROM lineitem UNION SELECT e.b FROM e JOIN r ON e.a = r.node) SELECT CAST(node AS BIGINT) AS node FROM r"""
)
def w_recursive_distinct(t: Tables) -> DataFrame:
    """Recursive UNION with duplicates removed: the parts and (below zero) suppliers that orders lead to from the first part."""
    sold = t.lineitem.select(c("l_partkey").alias("a"), (-c("l_suppkey")).alias("b"))
    return reachable(sold.union(sold.select("b", "a")).distinct(), t.lineitem.agg(F.min("l_partkey").alias("node")))


@query("SELECT r_name FROM region")
def w_foreign_scan_csv(t: Tables) -> DataFrame:
    """A scan of files of another format, which the engine does not own."""
    path = external(t, "region-csv", lambda where: t.region.select("r_regionkey", "r_name").write.csv(where))
    return t.spark.read.schema("k int, r_name string").csv(path).select("r_name")


@query("SELECT CAST(n_nationkey AS BIGINT) AS query_id, n_name AS app, CAST(n_regionkey AS INTEGER) AS pid FROM nation")
def w_custom_scan(t: Tables) -> DataFrame:
    """A scan by a data source of our own: a plan log with a record for each nation."""
    logfile.register(t.spark)
    path = external(t, "nation-log", lambda where: records(t).write.format("planlog").mode("append").option("path", where).save())
    return t.spark.read.format("planlog").option("path", path).load().select("query_id", c("ctx.app").alias("app"), c("ctx.pid").cast("int").alias("pid"))


@query("SELECT CAST(n_regionkey AS BIGINT) AS region, count(*) AS inserted FROM nation GROUP BY n_regionkey")
def w_transition_table(t: Tables) -> DataFrame:
    """What a statement trigger sees of the rows a statement inserted."""
    from planquill.streaming.triggers import audit

    return audit(t.nation.select(big(c("n_regionkey")).alias("region")), "region")


# Sort and limit ----------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def w_sort_limit(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def w_topk_desc(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(c("o_totalprice").desc(), "o_orderkey").limit(25)


@query("SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey")
def w_incremental_sort(t: Tables) -> DataFrame:
    """Ranges of the leading key, each sorted by the rest within its partition."""
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey").repartitionByRange("o_custkey").sortWithinPartitions("o_custkey", "o_orderdate", "o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 100")
def w_offset(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey").orderBy("o_orderkey").offset(100).limit(20)


# Grouping ----------------------------------------------------------------------------------------


@query("SELECT o_orderstatus FROM orders GROUP BY o_orderstatus")
def w_group_only(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.lit(1)).select("o_orderstatus")


@query("SELECT count(*) AS n, " + MONEY.format("o_totalprice") + " AS total, max(o_totalprice) AS most, min(o_orderkey) AS least FROM orders")
def w_agg_plain(t: Tables) -> DataFrame:
    return t.orders.agg(F.count("*").alias("n"), money("o_totalprice").alias("total"), F.max("o_totalprice").alias("most"), F.min("o_orderkey").alias("least"))


@query("SELECT o_custkey, count(*) AS n, " + MONEY.format("o_totalprice") + " AS total FROM orders GROUP BY o_custkey")
def w_agg_hash(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), money("o_totalprice").alias("total"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, " + MONEY.format("l_quantity") + " AS quantity FROM lineitem GROUP BY 1, 2")
def w_agg_partial_final(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), money("l_quantity").alias("quantity"))


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def w_agg_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"))


@query("SELECT c_mktsegment, coalesce(c_nationkey, -1) AS c_nationkey, count(*) AS n FROM customer GROUP BY ROLLUP (c_mktsegment, customer.c_nationkey)")
def w_agg_rollup(t: Tables) -> DataFrame:
    return t.customer.rollup("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n")).withColumn("c_nationkey", F.coalesce("c_nationkey", F.lit(-1)))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def w_agg_cube(t: Tables) -> DataFrame:
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def w_agg_grouping_sets(t: Tables) -> DataFrame:
    return t.orders.groupingSets([[c("o_orderstatus")], [c("o_orderpriority")], []], c("o_orderstatus"), c("o_orderpriority")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15")
def w_having(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 15")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def w_unique(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


# Windows -----------------------------------------------------------------------------------------


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders")
def w_window_row_number(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", big(F.row_number().over(w)).alias("rn"))


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def w_window_topn_per_group(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(c("o_totalprice").desc(), "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rn")).where("rn <= 3").withColumn("rn", big(c("rn")))


@query(
    "SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS recent FROM orders"
)
def w_window_frame(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return t.orders.select("o_orderkey", F.sum(c("o_totalprice").cast("decimal(18,2)")).over(w).cast("double").alias("recent"))


# Set operations ----------------------------------------------------------------------------------


def _two(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers with large orders, and customers with open ones; with repetitions."""
    return t.orders.where("o_totalprice > 250000").select("o_custkey"), t.orders.where("o_orderstatus = 'O'").select("o_custkey")


TWO = "SELECT o_custkey FROM orders WHERE o_totalprice > 250000 {} SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'"


@query(TWO.format("INTERSECT"))
def w_setop_intersect(t: Tables) -> DataFrame:
    a, b = _two(t)
    return a.intersect(b)


@query(TWO.format("INTERSECT ALL"))
def w_setop_intersect_all(t: Tables) -> DataFrame:
    a, b = _two(t)
    return a.intersectAll(b)


@query(TWO.format("EXCEPT"))
def w_setop_except(t: Tables) -> DataFrame:
    a, b = _two(t)
    return a.subtract(b)


@query(TWO.format("EXCEPT ALL"))
def w_setop_except_all(t: Tables) -> DataFrame:
    a, b = _two(t)
    return a.exceptAll(b)


@query(TWO.format("UNION ALL"))
def w_union_all(t: Tables) -> DataFrame:
    a, b = _two(t)
    return a.union(b)


@query("SELECT k FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey < 400 UNION ALL SELECT c_custkey FROM customer WHERE c_custkey < 400) ORDER BY k LIMIT 60")
def w_merge_append(t: Tables) -> DataFrame:
    a = t.orders.where("o_orderkey < 400").select(c("o_orderkey").alias("k"))
    return a.union(t.customer.where("c_custkey < 400").select("c_custkey")).orderBy("k").limit(60)


# Joins -------------------------------------------------------------------------------------------


@query("SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def w_join_hash(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.hint("shuffle_hash"), c("o_custkey") == c("c_custkey")).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def w_join_merge(t: Tables) -> DataFrame:
    return t.orders.hint("merge").join(t.lineitem, c("o_orderkey") == c("l_orderkey")).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT a.r_name AS a, b.r_name AS b FROM region a JOIN region b ON a.r_regionkey < b.r_regionkey")
def w_join_nested_loop(t: Tables) -> DataFrame:
    """Region has a fixed handful of rows."""
    a, b = t.region.alias("a"), t.region.alias("b")
    return a.join(b, c("a.r_regionkey") < c("b.r_regionkey")).select(c("a.r_name").alias("a"), c("b.r_name").alias("b"))


@query("SELECT n_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey AND o_totalprice > c_acctbal * 20 GROUP BY 1")
def w_join_theta(t: Tables) -> DataFrame:
    j = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    return j.join(t.nation, (c("c_nationkey") == c("n_nationkey")) & (c("o_totalprice") > c("c_acctbal") * 20)).groupBy("n_name").agg(F.count("*").alias("n"))


#: Whole numbers that an outer join leaves null are shown as -1, which no key is.
JOIN = "SELECT coalesce(c_custkey, -1) AS c_custkey, coalesce(o_orderkey, -1) AS o_orderkey FROM customer {} JOIN orders ON o_custkey = c_custkey AND o_totalprice > 250000"


def _sides(t: Tables) -> tuple[DataFrame, DataFrame, Column]:
    """Whole tables; only dear orders match, so that either side has rows without a partner."""
    return t.customer.select("c_custkey"), t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), (c("o_custkey") == c("c_custkey")) & (c("o_totalprice") > 250000)


def _shown(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*[F.coalesce(c(k), F.lit(-1).cast("long")).alias(k) for k in keys])


@query(JOIN.format("LEFT"))
def w_join_left(t: Tables) -> DataFrame:
    a, b, on = _sides(t)
    return _shown(a.join(b, on, "left"), "c_custkey", "o_orderkey")


@query(JOIN.format("RIGHT"))
def w_join_right(t: Tables) -> DataFrame:
    a, b, on = _sides(t)
    return _shown(a.join(b, on, "right"), "c_custkey", "o_orderkey")


@query(JOIN.format("FULL"))
def w_join_full(t: Tables) -> DataFrame:
    a, b, on = _sides(t)
    return _shown(a.join(b, on, "full"), "c_custkey", "o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def w_join_semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 200000"), c("o_custkey") == c("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def w_join_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 400000"), c("o_custkey") == c("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)")
def w_join_right_semi(t: Tables) -> DataFrame:
    """The right variants of semi and anti joins are the left ones with sides exchanged."""
    return t.orders.join(t.customer.where("c_acctbal < 0"), c("o_custkey") == c("c_custkey"), "left_semi").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def w_join_right_anti(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.where("c_acctbal > 0"), c("o_custkey") == c("c_custkey"), "left_anti").select("o_orderkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def w_join_cross_materialize(t: Tables) -> DataFrame:
    """Two tables of fixed size; the smaller is held once and met by every row."""
    return t.nation.crossJoin(F.broadcast(t.region)).select("r_name", "n_name")


@query("SELECT n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def w_join_memoize(t: Tables) -> DataFrame:
    """Repeated look-ups of one key: the dimension's distinct keys are built once and probed."""
    return t.supplier.join(t.nation.dropDuplicates(["n_nationkey"]), c("s_nationkey") == c("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


# Partitions, parallel and locking ----------------------------------------------------------------

PARTS = "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS part FROM orders"


def _parts(t: Tables) -> DataFrame:
    """Orders as a table partitioned by year; its partitions are what a scan appends."""
    d = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("part"))
    path = external(t, "orders-by-year", lambda where: d.repartition("part").write.partitionBy("part").parquet(where))
    return t.spark.read.schema(d.schema).parquet(path)


@query(f"SELECT part, count(*) AS n FROM ({PARTS}) GROUP BY part")
def w_append_partitions(t: Tables) -> DataFrame:
    return _parts(t).groupBy("part").agg(F.count("*").alias("n"))


@query(f"SELECT o_orderkey FROM ({PARTS}) WHERE part = 1995 AND o_totalprice > 1000")
def w_partition_prune(t: Tables) -> DataFrame:
    """Known when planned: other years' files are not listed."""
    return _parts(t).where("part = 1995 AND o_totalprice > 1000").select("o_orderkey")


@query(f"SELECT part, count(*) AS n FROM ({PARTS}) WHERE part IN (SELECT 1990 + n_nationkey FROM nation WHERE n_regionkey = 1) GROUP BY part")
def w_partition_prune_runtime(t: Tables) -> DataFrame:
    """Known when run: the years come from another table."""
    years = t.nation.where("n_regionkey = 1").select((c("n_nationkey") + 1990).cast("int").alias("year"))
    return _parts(t).join(F.broadcast(years), c("part") == c("year"), "left_semi").groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey % 64 AS bucket, count(*) AS n, " + MONEY.format("l_extendedprice") + " AS total FROM lineitem GROUP BY 1")
def w_parallel_bucket(t: Tables) -> DataFrame:
    return t.lineitem.groupBy((c("l_suppkey") % 64).alias("bucket")).agg(F.count("*").alias("n"), money("l_extendedprice").alias("total"))


@query("SELECT l_suppkey, l_orderkey FROM lineitem ORDER BY l_orderkey, l_suppkey")
def w_gather_merge(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_orderkey").orderBy("l_orderkey", "l_suppkey")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def w_lock_rows(t: Tables) -> DataFrame:
    """Rows read for update: a file snapshot cannot change under its reader, so no lock is needed."""
    return t.customer.where("c_acctbal < 0").select("c_custkey", "c_acctbal")


# Changes -----------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' ELSE p_brand END AS p_brand FROM part")
def w_update(t: Tables) -> DataFrame:
    return upsert.update(t.part.select("p_partkey", "p_brand", "p_size"), c("p_size") > 40, {"p_brand": F.lit("large")}).drop("p_size")


@query("SELECT p_partkey FROM part WHERE NOT p_size < 10")
def w_delete(t: Tables) -> DataFrame:
    return upsert.delete(t.part.select("p_partkey", "p_size"), c("p_size") < 10).select("p_partkey")


SOURCE = "(SELECT p_partkey + 1000 AS p_partkey, 'new' AS p_brand FROM part)"


def _source(t: Tables) -> DataFrame:
    return t.part.select((c("p_partkey") + 1000).alias("p_partkey"), F.lit("new").alias("p_brand"))


@query(f"SELECT coalesce(t.p_partkey, s.p_partkey) AS p_partkey, coalesce(s.p_brand, t.p_brand) AS p_brand FROM part t FULL JOIN {SOURCE} s ON t.p_partkey = s.p_partkey")
def w_insert_on_conflict(t: Tables) -> DataFrame:
    return upsert.insert_on_conflict(t.part.select("p_partkey", "p_brand"), _source(t), ["p_partkey"])


@query(
    f"""SELECT coalesce(t.p_partkey, s.p_partkey) AS p_partkey,
    CASE WHEN t.p_partkey IS NULL THEN 'inserted' WHEN s.p_partkey IS NULL THEN t.p_brand ELSE 'updated' END AS p_brand
    FROM part t FULL JOIN {SOURCE} s ON t.p_partkey = s.p_partkey WHERE NOT (s.p_partkey IS NOT NULL AND t.p_partkey IS NOT NULL AND t.p_size > 45)"""
)
def w_merge(t: Tables) -> DataFrame:
    target = t.part.select("p_partkey", "p_brand", "p_size")
    rules = [upsert.When("matched", c("t.p_size") > 45, "delete"), upsert.When("matched", None, "update", {"p_brand": F.lit("updated")}), upsert.When("not matched", None, "insert", {"p_brand": F.lit("inserted")})]
    return upsert.merge(target, _source(t), ["p_partkey"], rules).select("p_partkey", "p_brand")


@query(
    f"""SELECT count(*) FILTER (WHERE t.p_partkey IS NULL) AS inserted,
    count(*) FILTER (WHERE t.p_partkey IS NOT NULL AND s.p_partkey IS NOT NULL AND t.p_size <= 45) AS updated,
    count(*) FILTER (WHERE t.p_partkey IS NOT NULL AND s.p_partkey IS NOT NULL AND t.p_size > 45) AS deleted,
    count(*) FILTER (WHERE s.p_partkey IS NULL) AS skipped
    FROM part t FULL JOIN {SOURCE} s ON t.p_partkey = s.p_partkey"""
)
def w_merge_counts(t: Tables) -> DataFrame:
    target = t.part.select("p_partkey", "p_brand", "p_size")
    rules = [upsert.When("matched", c("t.p_size") > 45, "delete"), upsert.When("matched", None, "update", {"p_brand": F.lit("updated")}), upsert.When("not matched", None, "insert", {})]
    return upsert.merge_counts(target, _source(t), ["p_partkey"], rules)


# Subqueries --------------------------------------------------------------------------------------


@query("SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 49)")
def w_exists_correlated(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_quantity > 49"), c("l_orderkey") == c("o_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT 1.9 * avg(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)")
def w_scalar_subquery(t: Tables) -> DataFrame:
    mean = t.orders.agg((F.avg(c("o_totalprice").cast("decimal(18,2)")).cast("double") * 1.9).alias("m"))
    return t.orders.where(c("o_totalprice") > mean.scalar()).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def w_in_subquery(t: Tables) -> DataFrame:
    return t.customer.join(t.nation.where("n_regionkey = 1"), c("n_nationkey") == c("c_nationkey"), "left_semi").select("c_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7 AND o_totalprice > 1000")
def w_prepared(t: Tables) -> DataFrame:
    """A statement with parameters."""
    t.orders.createOrReplaceTempView("planquill_orders")
    return t.spark.sql("SELECT o_orderkey, o_totalprice FROM planquill_orders WHERE o_custkey = :who AND o_totalprice > :least", args={"who": 7, "least": 1000})


@query("SELECT o_orderkey, o_orderdate + INTERVAL 3 DAY AS due, CAST(year(o_orderdate) AS INTEGER) AS y, repeat('x', CAST(o_orderkey % 4 AS INTEGER)) AS pad, CAST(length(o_orderpriority) AS INTEGER) AS n, greatest(o_orderkey % 9, 3) AS g FROM orders")
def w_expressions(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", (c("o_orderdate") + F.make_dt_interval(F.lit(3))).alias("due"), F.year("o_orderdate").alias("y"),
        F.expr("repeat('x', cast(o_orderkey % 4 as int))").alias("pad"), F.length("o_orderpriority").alias("n"), F.greatest(c("o_orderkey") % 9, F.lit(3).cast("long")).alias("g"),
    )


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN round(c_acctbal + 10.0, 2) ELSE c_acctbal END AS c_acctbal FROM customer")
def w_transaction_accounts(t: Tables) -> DataFrame:
    """The balance change of a bank transaction, over every account that it names."""
    deltas = t.customer.where("c_custkey % 3 = 0").select(c("c_custkey").alias("aid"), F.lit(10.0).alias("delta"))
    return t.customer.join(deltas, c("aid") == c("c_custkey"), "left").select("c_custkey", F.when(c("delta").isNotNull(), F.round(c("c_acctbal") + c("delta"), 2)).otherwise(c("c_acctbal")).alias("c_acctbal"))


# Benchmark shapes --------------------------------------------------------------------------------


@query("SELECT c_acctbal FROM customer WHERE c_custkey = 77")
def w_shape_simple_point(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey = 77").select("c_acctbal")


@query("SELECT count(*) AS n, " + MONEY.format("c_acctbal") + " AS total FROM customer WHERE c_custkey BETWEEN 50 AND 149")
def w_shape_simple_range(t: Tables) -> DataFrame:
    return t.customer.where(c("c_custkey").between(50, 149)).agg(F.count("*").alias("n"), money("c_acctbal").alias("total"))


@query("SELECT c_mktsegment, count(*) AS n, " + MONEY.format("o_totalprice") + " AS total FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0 AND o_orderstatus IN ('F', 'O') GROUP BY 1")
def w_shape_join_agg(t: Tables) -> DataFrame:
    j = t.customer.where("c_acctbal > 0").join(t.orders.where(c("o_orderstatus").isin("F", "O")), c("o_custkey") == c("c_custkey"))
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("n"), money("o_totalprice").alias("total"))


@query(
    """WITH spent AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey),
    ranked AS (SELECT c_nationkey, c_custkey, total, row_number() OVER (PARTITION BY c_nationkey ORDER BY total DESC, c_custkey) AS rn FROM customer JOIN spent ON o_custkey = c_custkey)
    SELECT n_name, c_custkey, total, rn FROM ranked JOIN nation ON n_nationkey = c_nationkey WHERE rn <= 5"""
)
def w_shape_complex(t: Tables) -> DataFrame:
    spent = t.orders.where("o_orderstatus <> 'P'").groupBy("o_custkey").agg(money("o_totalprice").alias("total"))
    w = Window.partitionBy("c_nationkey").orderBy(c("total").desc(), "c_custkey")
    ranked = t.customer.join(spent, c("o_custkey") == c("c_custkey")).withColumn("rn", F.row_number().over(w)).where("rn <= 5")
    return ranked.join(t.nation, c("n_nationkey") == c("c_nationkey")).select("n_name", "c_custkey", "total", big(c("rn")).alias("rn"))


@query(
    """WITH lines AS (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey),
    placed AS (SELECT o_orderkey, o_custkey, o_totalprice, coalesce(n, 0) AS n, coalesce(quantity, 0) AS quantity FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
      WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.05)),
    ranked AS (SELECT c_nationkey, c_mktsegment, o_totalprice, n, quantity, row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM placed JOIN customer ON c_custkey = o_custkey),
    by_nation AS (SELECT c_nationkey, c_mktsegment, count(*) AS orders, CAST(sum(n) AS BIGINT) AS lines, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM ranked WHERE rn <= 4 GROUP BY 1, 2)
    SELECT r_name, c_mktsegment, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM by_nation JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2"""
)
def w_shape_very_complex(t: Tables) -> DataFrame:
    """Three steps of aggregation with an outer join, EXISTS and a window between them."""
    # One pass over the lines tells both how many count and whether one is discounted; only orders with such a line stay.
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count_if(c("l_returnflag") != "N").alias("n"), F.bool_or(c("l_discount") > 0.05).alias("discounted"))
    placed = t.orders.join(lines.where("discounted"), c("l_orderkey") == c("o_orderkey")).select("o_orderkey", "o_custkey", "o_totalprice", "n")
    w = Window.partitionBy("c_custkey").orderBy(c("o_totalprice").desc(), "o_orderkey")
    ranked = placed.join(t.customer, c("c_custkey") == c("o_custkey")).withColumn("rn", F.row_number().over(w)).where("rn <= 4")
    nations = ranked.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("orders"), F.sum("n").alias("lines"), money("o_totalprice").alias("total"))
    named = nations.join(t.nation, c("n_nationkey") == c("c_nationkey")).join(t.region, c("r_regionkey") == c("n_regionkey"))
    return named.groupBy("r_name", "c_mktsegment").agg(F.sum("orders").alias("orders"), F.sum("lines").alias("lines"), money("total").alias("total"))
