"""The library's queries over the shared star-schema tables, which stand in for filings and grants, with SQL that says
the same. Orders and line items are grants: customers give, suppliers receive, the order's year is the tax year."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions import scalars as S
from grantlake.functions import textsearch as T
from grantlake.operators import grants as G
from grantlake.operators import latest as L
from grantlake.operators import linkage as K
from grantlake.operators import quality as Q
from grantlake.plans import canonical as C
from grantlake.plans import explorer as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _half(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").where(condition).join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.selectExpr(
        "lpad(cast(o_custkey as string), 9, '0') as granter_ein", "concat('Giver ', o_custkey) as granter_name", "cast(null as string) as granter_name2",
        "case when l_linestatus = 'F' then md5(cast(l_orderkey as string)) end as filesha256", "year(o_orderdate) as taxyear",
        "case when l_suppkey % 10 <> 0 then lpad(cast(l_suppkey as string), 9, '0') end as grantee_ein", "concat('Org ', l_suppkey % 37) as grantee_organization_name1",
        "cast(null as string) as grantee_organization_name2", "cast(null as string) as grantee_person_name",
        "case when l_linenumber < 7 then cast(floor(l_extendedprice) as bigint) end as grant_amount", "concat(l_returnflag, ' ', l_partkey) as grant_purpose",
    )


def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping halves as a set."""
    return G.union_grants(_half(spark, sf_dir, "l_quantity < 30"), _half(spark, sf_dir, "l_quantity > 20"))


# Customers file one form or the other by their market segment, and those of one segment both.
_CHARITIES = "c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE')"
_FUNDS = "c_mktsegment not in ('AUTOMOBILE', 'BUILDING')"


def nonprofits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").where(_CHARITIES).selectExpr("lpad(cast(c_custkey as string), 9, '0') as ein", "c_name as name")


def funders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").where(_FUNDS).selectExpr("lpad(cast(c_custkey as string), 9, '0') as ein", "concat('Fund ', c_name) as name")


def _payees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "supplier").where("s_acctbal >= 1000").selectExpr("lpad(cast(s_suppkey as string), 9, '0') as ein", "s_name as name")


_HALF = """SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS granter_ein, 'Giver ' || o_custkey AS granter_name, CASE WHEN l_linestatus = 'F' THEN md5(CAST(l_orderkey AS VARCHAR)) END AS filesha256,
 CAST(year(o_orderdate) AS INT) AS taxyear, CASE WHEN l_suppkey % 10 <> 0 THEN lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS grantee_ein, 'Org ' || (l_suppkey % 37) AS grantee_organization_name1,
 CASE WHEN l_linenumber < 7 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS grant_amount, l_returnflag || ' ' || l_partkey AS grant_purpose
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE """
_WITH = f"""WITH g AS ({_HALF} l_quantity < 30 UNION {_HALF} l_quantity > 20),
n AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ein, c_name AS name FROM customer WHERE {_CHARITIES}),
f AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ein, 'Fund ' || c_name AS name FROM customer WHERE {_FUNDS}),
p AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS ein, s_name AS name FROM supplier WHERE s_acctbal >= 1000),
r AS (SELECT g.*, coalesce(CASE WHEN filesha256 IS NOT NULL THEN f.name ELSE n.name END, f.name, n.name, granter_name) AS resolved_granter_name
 FROM g LEFT JOIN n ON n.ein = granter_ein LEFT JOIN f ON f.ein = granter_ein)
"""
_AWAY = "CAST(CASE WHEN {0} < 0 THEN ceil({0} - 0.5) ELSE floor({0} + 0.5) END AS BIGINT)"
_SUMS = f"count(*) AS grant_count, coalesce(CAST(sum(grant_amount) AS BIGINT), 0) AS total_amount, coalesce({_AWAY.format('avg(grant_amount)')}, 0) AS avg_amount"


@query(_WITH + "SELECT granter_ein, granter_name, filesha256, taxyear, grantee_ein, grantee_organization_name1, grant_amount, grant_purpose FROM g")
def unioned_grants(spark, sf_dir):
    return grants(spark, sf_dir).select("granter_ein", "granter_name", "filesha256", "taxyear", "grantee_ein", "grantee_organization_name1", "grant_amount", "grant_purpose")


@query(_WITH + """SELECT grantee_ein AS ein, taxyear, CAST(coalesce(sum(grant_amount), 0) AS DOUBLE) AS total_grant_amount, count(*) AS grant_count,
 list_sort(list(DISTINCT granter_ein)) AS granter_eins, list_sort(list(DISTINCT resolved_granter_name)) AS granter_names FROM r GROUP BY 1, 2""")
def grant_summaries(spark, sf_dir):
    return G.summaries_named(grants(spark, sf_dir), nonprofits(spark, sf_dir), funders(spark, sf_dir), "grantee")


@query(_WITH + "SELECT granter_ein, grantee_ein, taxyear, grant_amount, grant_purpose, resolved_granter_name FROM r WHERE grantee_ein IN ('000000003', '000000017', '000000042') AND taxyear >= 1997")
def grants_by_ein_list(spark, sf_dir):
    rows = G.for_eins(grants(spark, sf_dir), ["000000003", "000000017", "000000042"], "grantee", 1997)
    return G.with_granter_name(rows, nonprofits(spark, sf_dir), funders(spark, sf_dir)).select("granter_ein", "grantee_ein", "taxyear", "grant_amount", "grant_purpose", "resolved_granter_name")


_PAGE = "SELECT granter_ein, grantee_ein, taxyear, grant_amount, grant_purpose FROM g"


@query(_WITH + _PAGE + " WHERE granter_ein = '000000007' ORDER BY taxyear DESC NULLS FIRST, grant_amount DESC NULLS FIRST, grantee_ein NULLS FIRST, grant_purpose LIMIT 10 OFFSET 10")
def grants_given_page(spark, sf_dir):
    return G.page_of(grants(spark, sf_dir), "granter", "000000007", 2, 10, tie=[F.col("grantee_ein").asc_nulls_first(), F.col("grant_purpose")]).select("granter_ein", "grantee_ein", "taxyear", "grant_amount", "grant_purpose")


@query(_WITH + _PAGE + """ WHERE grantee_ein = '000000017' AND grant_amount BETWEEN 20000 AND 60000 AND (granter_name ILIKE '%1%' OR grant_purpose ILIKE '%1%')
 ORDER BY grant_amount ASC NULLS LAST, taxyear DESC NULLS FIRST, granter_ein, grant_purpose LIMIT 25""")
def grants_received_page(spark, sf_dir):
    by = G.GrantFilter(search="1", min_amount=20000, max_amount=60000, sort="grant_amount", ascending=True)
    return G.page_of(grants(spark, sf_dir), "grantee", "000000017", 1, 25, by, tie=["granter_ein", "grant_purpose"]).select("granter_ein", "grantee_ein", "taxyear", "grant_amount", "grant_purpose")


@query(_WITH + f"SELECT count(*) AS total_count, coalesce(CAST(sum(grant_amount) AS BIGINT), 0) AS total_amount, coalesce({_AWAY.format('avg(grant_amount)')}, 0) AS avg_amount FROM g WHERE grantee_ein = '000000017' AND taxyear BETWEEN 1996 AND 1999")
def grants_filtered_totals(spark, sf_dir):
    return G.totals(grants(spark, sf_dir), "grantee", "000000017", G.GrantFilter(min_year=1996, max_year=1999))


@query(_WITH + f"SELECT CAST(taxyear AS VARCHAR) AS group_key, {_SUMS} FROM g GROUP BY taxyear")
def grants_grouped_year(spark, sf_dir):
    return G.grouped_by_year(grants(spark, sf_dir))


@query(_WITH + f""", m AS (SELECT coalesce(grantee_ein, '__name:' || coalesce(grantee_organization_name1, '')) AS group_key, grantee_ein AS group_ein, grantee_organization_name1 AS nm, grant_amount FROM g),
 c AS (SELECT group_key, nm, row_number() OVER (PARTITION BY group_key ORDER BY count(*) DESC, nm) AS i FROM m GROUP BY 1, 2),
 a AS (SELECT group_key, group_ein, {_SUMS} FROM m GROUP BY 1, 2)
 SELECT a.*, coalesce(p.name, f.name, c.nm, 'Unknown') AS label FROM a LEFT JOIN c ON c.group_key = a.group_key AND i = 1 LEFT JOIN p ON p.ein = group_ein LEFT JOIN f ON f.ein = group_ein""")
def grants_grouped_entity(spark, sf_dir):
    return G.grouped_by_entity(grants(spark, sf_dir), "grantee", _payees(spark, sf_dir), funders(spark, sf_dir))


@query(_WITH + f"SELECT CAST(taxyear AS VARCHAR) AS group_key, {_SUMS} FROM g WHERE granter_ein = '000000007' GROUP BY taxyear ORDER BY taxyear DESC LIMIT 3 OFFSET 3")
def grants_grouped_year_page(spark, sf_dir):
    return G.group_page(G.grouped_by_year(G.for_eins(grants(spark, sf_dir), ["000000007"], "granter")), True, 2, 3)


@query(_WITH + f"SELECT coalesce(grantee_ein, '__name:' || coalesce(grantee_organization_name1, '')) AS group_key, {_SUMS} FROM g WHERE taxyear >= 1995 GROUP BY 1 ORDER BY total_amount DESC, group_key LIMIT 20 OFFSET 20")
def grants_grouped_entity_page(spark, sf_dir):
    groups = G.grouped_by_entity(grants(spark, sf_dir).where(G.GrantFilter(min_year=1995).condition("grantee")), "grantee", _payees(spark, sf_dir), funders(spark, sf_dir))
    return G.group_page(groups.drop("group_ein", "label"), False, 2, 20)


@query(_WITH + """SELECT granter_ein, grantee_organization_name1, taxyear, grant_amount, grant_purpose FROM g WHERE granter_ein = '000000007' AND grantee_ein IS NULL AND grantee_organization_name1 =
 (SELECT min(grantee_organization_name1) FROM g WHERE granter_ein = '000000007' AND grantee_ein IS NULL)""")
def grants_expand_group(spark, sf_dir):
    rows = grants(spark, sf_dir)
    name = G.for_eins(rows, ["000000007"], "granter").where("grantee_ein is null").agg(F.min("grantee_organization_name1")).first()[0]
    return G.expand_group(rows, "granter", "000000007", f"__name:{name}", False, tie=["grant_purpose"]).select("granter_ein", "grantee_organization_name1", "taxyear", "grant_amount", "grant_purpose")


@query(_WITH + "SELECT count(DISTINCT coalesce(grantee_ein, '__name:' || coalesce(grantee_organization_name1, ''))) AS total_groups FROM g")
def grants_number_of_groups(spark, sf_dir):
    return G.number_of_groups(grants(spark, sf_dir), G.entity_key("grantee"))


@query(_WITH + """, y AS (SELECT grantee_ein AS ein, taxyear, coalesce(sum(grant_amount), 0) AS total, count(*) AS n FROM g WHERE taxyear >= 1996 AND grantee_ein IS NOT NULL GROUP BY 1, 2)
 SELECT ein, CAST(sum(n) AS BIGINT) AS num_grants FROM y GROUP BY 1 HAVING avg(total) >= 3000000 AND sum(n) >= 500""")
def grant_eligibility_having(spark, sf_dir):
    return G.grant_eligible(grants(spark, sf_dir), "grantee", 1996, 3_000_000, 500).select("ein", "num_grants")


@query("SELECT o_custkey AS ein, CAST(floor(sum(t) / count(t)) AS BIGINT) AS avg_amount FROM (SELECT o_custkey, year(o_orderdate) AS y, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS t FROM orders GROUP BY 1, 2) GROUP BY 1 HAVING avg(t) >= 400000")
def min_avg_contributions(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    out = G.min_avg(rows, "o_custkey", "y", F.col("o_totalprice").cast("decimal(18,2)"), 400_000)
    return out.select("ein", F.floor("avg_amount").cast("bigint").alias("avg_amount"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS i FROM orders) WHERE i = 1")
def latest_order_per_customer(spark, sf_dir):
    return L.latest_per_key(_t(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC NULLS LAST) AS i FROM orders) WHERE i = 1")
def latest_year_orders_dense_rank(spark, sf_dir):
    return L.latest_group(_t(spark, sf_dir, "orders"), ["o_custkey"], F.year("o_orderdate")).select("o_custkey", "o_orderkey")


@query("""SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY text) AS unique_text_compact, count(*) AS n_snippets
 FROM (SELECT DISTINCT conv_id, text FROM (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn // 2 DESC NULLS LAST) AS i FROM conversations WHERE coalesce(text, '') <> '') WHERE i = 1) GROUP BY 1""")
def conversation_text_latest(spark, sf_dir):
    rows = _t(spark, sf_dir, "conversations").where(S.is_filled(F.col("text"))).withColumn("half", F.expr("turn div 2"))
    return C.narrative_text(rows, "conv_id", "half", "text")


# Word boundaries spelt out, so that both engines part words at the same characters.
_A, _Z = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"


@query(f"""SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i){_A}the{_Z}') AND regexp_matches(text, '(?i){_A}of\\s*(a|the){_Z}') AND NOT regexp_matches(text, '(?i){_A}was\\s+[a-z]{_Z}')""".replace("\\\\", "\\"))
def narrative_regex_filter(spark, sf_dir):
    t = F.col("text")
    return _t(spark, sf_dir, "documents").where(t.rlike(rf"(?i){_A}the{_Z}") & t.rlike(rf"(?i){_A}of\s*(a|the){_Z}") & ~t.rlike(rf"(?i){_A}was\s+[a-z]{_Z}")).select("doc_id")


@query(f"""SELECT doc_id FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'FORM 990, ' WHEN 1 THEN '990-EZ ' WHEN 2 THEN 'Schedule A 990 ' ELSE '1990 ' END || CASE doc_id % 3 WHEN 0 THEN 'Part III' WHEN 1 THEN 'PART 3, line 4' ELSE 'part iv' END AS label, text FROM documents)
 WHERE regexp_matches(label, '(?i){_A}990{_Z}') AND regexp_matches(label, '(?i){_A}part\\s*(iii|3){_Z}') AND NOT regexp_matches(label, '(?i){_A}schedule\\s+[a-z]{_Z}') AND coalesce(text, '') <> ''""".replace("\\\\", "\\"))
def schedule_o_part_iii(spark, sf_dir):
    label = "concat(case doc_id % 4 when 0 then 'FORM 990, ' when 1 then '990-EZ ' when 2 then 'Schedule A 990 ' else '1990 ' end, case doc_id % 3 when 0 then 'Part III' when 1 then 'PART 3, line 4' else 'part iv' end)"
    rows = _t(spark, sf_dir, "documents").selectExpr("doc_id", f"{label} as sidfalrdesc", "text as supinfdetexp")
    return C.schedule_o_part_iii(rows).select("doc_id")


_PEOPLE = "(SELECT '  ' || upper(c_name) || ' ' AS name, CAST(c_nationkey AS VARCHAR) AS ein, c_custkey % 9 AS year, false AS pf FROM customer UNION ALL SELECT replace(s_name, 'Supplier', 'Customer'), CAST(s_nationkey AS VARCHAR), s_suppkey % 9, true FROM supplier)"


@query(f"""SELECT CAST(CAST(md5(nn || '|' || ein) AS UUID) AS VARCHAR) AS person_id, name, nn AS name_normalized, ein, first_taxyear, last_taxyear, n_filings, seen_on_990, seen_on_990pf FROM (
 SELECT trim(regexp_replace(lower(name), '\\s+', ' ', 'g')) AS nn, ein, max(name) AS name, CAST(min(year) AS INT) AS first_taxyear, CAST(max(year) AS INT) AS last_taxyear, count(*) AS n_filings, bool_or(NOT pf) AS seen_on_990, bool_or(pf) AS seen_on_990pf FROM {_PEOPLE} GROUP BY 1, 2)""")
def person_rollup(spark, sf_dir):
    a = _t(spark, sf_dir, "customer").selectExpr("concat('  ', upper(c_name), ' ') as namepeperson", "cast(c_nationkey as string) as filerein", "cast(c_custkey % 9 as string) as taxyear")
    b = _t(spark, sf_dir, "supplier").selectExpr("replace(s_name, 'Supplier', 'Customer') as odtkeiodtokepn", "cast(s_nationkey as string) as filerein", "cast(s_suppkey % 9 as string) as taxyear")
    return C.person_canonical(a, b).drop("_built_at")


@query("""SELECT c_name AS name, CAST(c_acctbal AS DECIMAL(38, 10)) AS hours, CAST(NULL AS DECIMAL(38, 10)) AS other, c_mktsegment <> '' AS is_officer, '990' AS source_form FROM customer
 UNION ALL SELECT s_name, CAST(NULL AS DECIMAL(38, 10)), CAST(s_acctbal AS DECIMAL(38, 10)), NULL, '990-PF' FROM supplier""")
def role_union_null_padded(spark, sf_dir):
    none = F.lit(None).cast("decimal(38,10)")
    number = lambda c: S.to_decimal(F.col(c).cast("decimal(18,2)").cast("string"))
    a = _t(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), number("c_acctbal").alias("hours"), none.alias("other"), S.is_filled(F.col("c_mktsegment")).alias("is_officer"), F.lit("990").alias("source_form"))
    b = _t(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), none.alias("hours"), number("s_acctbal").alias("other"), F.lit(None).cast("boolean").alias("is_officer"), F.lit("990-PF").alias("source_form"))
    return a.unionByName(b)


@query("""SELECT o_custkey AS ein, max(o_orderstatus) AS status, max(o_orderpriority) AS priority, CAST(min(year(o_orderdate)) AS INT) AS first_year, CAST(max(year(o_orderdate)) AS INT) AS last_year,
 CAST(sum(CAST(o_totalprice AS BIGINT)) AS BIGINT) AS revenue, bool_or(o_orderstatus = 'P') AS has_daf FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders) GROUP BY 1""")
def org_profile_rollup(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").selectExpr("o_custkey as filerein", "o_orderstatus as status", "o_orderpriority as priority", "cast(year(o_orderdate) as string) as taxyear", "cast(cast(floor(o_totalprice) as bigint) as string) as rev", "case when o_orderstatus = 'P' then 'true' else '0' end as donoadvifund")
    return X.org_rollup(rows, "rev", ("status", "priority"))


@query("SELECT CAST(year(o_orderdate) AS INT) AS taxyear, CAST(floor(o_totalprice) AS BIGINT) AS revenue FROM orders WHERE o_custkey = 7")
def revenue_history(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").selectExpr("cast(o_custkey as string) as filerein", "cast(year(o_orderdate) as string) as taxyear", "cast(cast(o_totalprice as decimal(18,2)) as string) as rev")
    return X.revenue_history(rows, "7", "rev")


@query("SELECT CAST(o_custkey AS VARCHAR) AS ein, CAST(year(o_orderdate) AS INT) AS taxyear, bool_or(o_orderpriority = '1-URGENT') AS flag FROM orders GROUP BY 1, 2")
def flag_by_year(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").selectExpr("cast(o_custkey as string) as filerein", "cast(year(o_orderdate) as string) as taxyear", "o_orderpriority")
    return X.flag_by_year(rows, F.col("o_orderpriority").isin("1-URGENT"))


@query("SELECT o_custkey AS ein, CAST(min(year(o_orderdate)) AS INT) AS first_year FROM orders GROUP BY 1")
def first_year_lookup(spark, sf_dir):
    return X.first_years(_t(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("string").alias("taxyear")), "o_custkey")


@query("SELECT p_partkey, CAST(slot AS INT) AS slot, description FROM (SELECT p_partkey, unnest([p_name, nullif(p_brand, 'Brand#7'), p_type]) AS description, unnest(range(3)) AS slot FROM part) WHERE coalesce(description, '') <> ''")
def program_slots_unpivot(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").withColumn("b", F.nullif("p_brand", F.lit("Brand#7")))
    return X.program_slots(rows, "p_partkey", "p_name", "b", "p_type")


@query("""SELECT p_partkey, CAST(coalesce(CASE WHEN p_brand <> 'Brand#7' THEN p_size END, 0) + coalesce(CASE WHEN p_size <> 4 THEN p_size END, 0) AS BIGINT) AS total, CAST((p_brand <> 'Brand#7')::INT + (p_size <> 4)::INT AS INT) AS slots
 FROM part WHERE p_brand <> 'Brand#7' OR p_size <> 4""")
def activity_slots_array(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").selectExpr("p_partkey", "nullif(p_brand, 'Brand#7') as d1", "case when p_brand <> 'Brand#7' then cast(p_size as string) end as a1", "case when p_size <> 4 then p_type end as d2", "case when p_size <> 4 then concat(p_size, '.9') end as a2")
    out = X.activity_slots(rows, ["p_partkey"], [("d1", "a1"), ("d2", "a2")])
    return out.select("p_partkey", X.activity_total(F.col("activities")).alias("total"), F.size("activities").alias("slots"))


_ARM = "SELECT lpad(CAST({k} AS VARCHAR), 9, '0') AS ein, {n} AS name1, '{t}' AS org_type, CAST(CASE WHEN {k} = 42 THEN 2000000 ELSE 1000000 END AS DOUBLE) AS rank, CAST(2000 + {k} % 7 AS INT) AS last_year FROM {f} WHERE {k} = 42 OR {n} ILIKE '%4_%'"


def _arm(spark, sf_dir, table, key, name, kind, fetch):
    rows = _t(spark, sf_dir, table).selectExpr(f"lpad(cast({key} as string), 9, '0') as ein", f"{name} as name", "cast(null as string) as name_secondary", "'x' as city", "'y' as state", f"cast(2000 + {key} % 7 as string) as latest_taxyear")
    return X.search_arm(rows, "4_", "000000042", kind, fetch, names=("name", "name_secondary"))


@query("WITH a AS (" + _ARM.format(k="c_custkey", n="c_name", t="nonprofit", f="customer") + ") SELECT *, (SELECT count(*) FROM a) AS total FROM a ORDER BY rank DESC, last_year DESC, name1, ein LIMIT 40")
def name_search_tiered(spark, sf_dir):
    return _arm(spark, sf_dir, "customer", "c_custkey", "c_name", "nonprofit", 40).select("ein", "name1", "org_type", "rank", "last_year", "total")


@query("SELECT ein, name1, org_type, rank, last_year FROM (" + _ARM.format(k="c_custkey", n="c_name", t="nonprofit", f="customer") + " UNION ALL " + _ARM.format(k="s_suppkey", n="s_name", t="foundation", f="supplier") + ") ORDER BY rank DESC, last_year DESC, name1, ein LIMIT 20 OFFSET 20")
def two_arm_search_merge(spark, sf_dir):
    arms = [_arm(spark, sf_dir, "customer", "c_custkey", "c_name", "nonprofit", 40), _arm(spark, sf_dir, "supplier", "s_suppkey", "s_name", "foundation", 40)]
    return X.merge_arms(arms, 2, 20).select("ein", "name1", "org_type", "rank", "last_year")


def _docs(spark, sf_dir):
    """All documents, whatever their language and letters, with tokens."""
    return _t(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("doc"))


_TOK = r"WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents)"


@query(_TOK + " SELECT doc_id FROM d WHERE list_contains(w, 'onth') AND list_contains(w, 'reth')")
def search_exact_term(spark, sf_dir):
    return _docs(spark, sf_dir).where(T.matches(F.col("doc"), T.plain("Reth onth"))).select("doc_id")


@query(_TOK + " SELECT doc_id FROM d WHERE len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) > 0")
def search_exact_phrase(spark, sf_dir):
    return _docs(spark, sf_dir).where(T.matches(F.col("doc"), T.phrase("of the"))).select("doc_id")


def _or_sql(words):
    part = "CAST(coalesce(list_aggregate(list_transform(range(1, 1 + least(256, len(list_filter(w, lambda x: x = '{0}')))), lambda j: 1.0 / (j * j)), 'sum'), 0) AS DOUBLE)"
    return " + ".join(part.format(w) for w in words)


@query(_TOK + f" SELECT doc_id, round(0.1 * ({_or_sql(['onth', 'reth'])}) / 1.64493406685 / 2, 9) AS rank FROM d WHERE list_contains(w, 'onth') OR list_contains(w, 'reth')")
def search_or_keywords_ranked(spark, sf_dir):
    q = T.any_of(["onth", " ", "reth"], "exact_words")
    return _docs(spark, sf_dir).where(T.matches(F.col("doc"), q)).select("doc_id", F.round(T.rank(F.col("doc"), q), 9).alias("rank"))


@query(_TOK + """ SELECT doc_id, round(1 - exp(list_aggregate(list_transform(pp, lambda z: ln(1 - CASE WHEN abs(z) > 100 THEN 1e-30 ELSE sqrt(0.01 / (1.005 + 0.05 * exp(abs(z) / 1.5 - 2))) END)), 'sum')), 7) AS rank FROM (
 SELECT doc_id, flatten(list_transform(pa, lambda x: list_transform(pb, lambda y: x - y))) AS pp FROM (
 SELECT doc_id, list_slice(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'onth'), 1, 256) AS pa, list_slice(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'reth'), 1, 256) AS pb FROM d) WHERE len(pa) > 0 AND len(pb) > 0)""")
def search_and_ranked(spark, sf_dir):
    q = T.plain("onth reth")
    return _docs(spark, sf_dir).where(T.matches(F.col("doc"), q)).select("doc_id", F.round(T.rank(F.col("doc"), q), 7).alias("rank"))


@query(_TOK + " SELECT doc_id FROM d WHERE len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) > 0 OR (list_contains(w, 'onth') AND NOT list_contains(w, 'reth'))")
def search_websearch(spark, sf_dir):
    return _docs(spark, sf_dir).where(T.matches(F.col("doc"), T.websearch('"of the" OR onth -reth', "simple"))).select("doc_id")


# What the stemmer takes to "onth" and "reth"; the test holds this against the stemmer.
STEMS = {w: w + "(s|e|es|ed|edly|ing|ings|ingly|ly|lyed|lying)?" for w in ("onth", "reth")}
_N = "len(list_filter(w, lambda x: regexp_full_match(x, '{0}')))"


@query(_TOK + " SELECT doc_id, round(0.1 * (" + " + ".join(f"CAST(coalesce(list_aggregate(list_transform(range(1, 1 + least(256, {_N.format(p)})), lambda j: 1.0 / (j * j)), 'sum'), 0) AS DOUBLE)" for p in STEMS.values())
       + ") / 1.64493406685 / 2, 9) AS rank FROM d WHERE " + " OR ".join(f"{_N.format(p)} > 0" for p in STEMS.values()))
def search_stemmed(spark, sf_dir):
    q = T.any_of(["onthing", "reths"], "stemmed")
    docs = T.english(_docs(spark, sf_dir), "doc_id", "doc")
    return docs.where(T.matches(F.col("doc"), q)).select("doc_id", F.round(T.rank(F.col("doc"), q), 9).alias("rank"))


# With two words a cover is a pair of neighbours that differ, among the places of both.
@query(_TOK + """, p AS (SELECT doc_id, least(i, 16383) AS pos, x FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE x IN ('onth', 'reth')),
 l AS (SELECT *, lag(pos) OVER o AS before, lag(x) OVER o AS other FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos, x))
 SELECT doc_id, round(sum(CASE WHEN other <> x THEN 0.1 / (1 + greatest(0, pos - before - 1)) ELSE 0 END), 9) AS rank FROM l GROUP BY 1 HAVING count(DISTINCT x) = 2""")
def search_cover_density(spark, sf_dir):
    q = T.plain("onth reth")
    return _docs(spark, sf_dir).where(T.matches(F.col("doc"), q)).select("doc_id", F.round(T.cover_density(q)(F.col("doc")), 9).alias("rank"))


@query(_TOK + " SELECT lexeme, doc_id, list_sort(list(CAST(least(i, 16383) AS INT))) AS positions FROM (SELECT doc_id, unnest(w) AS lexeme, unnest(range(1, len(w) + 1)) AS i FROM d) GROUP BY 1, 2")
def inverted_index_build(spark, sf_dir):
    index = T.inverted_index(_docs(spark, sf_dir), "doc_id", "doc")
    return index.withColumn("positions", F.transform("positions", lambda p: F.least(p, F.lit(T.LAST_POSITION))))


@query(_TOK + " SELECT doc_id FROM d WHERE list_contains(w, 'onth') AND list_contains(w, 'reth')")
def inverted_index_search(spark, sf_dir):
    return T.search_index(T.inverted_index(_docs(spark, sf_dir), "doc_id", "doc"), "doc_id", T.plain("reth onth"))


def _sides(spark, sf_dir):
    """Parts as recipients and organisations, blocked by brand; a name with the size appended is what may be mistyped."""
    part = _t(spark, sf_dir, "part")
    left = part.where("p_partkey % 2 = 0").selectExpr("p_partkey as recipient", "p_brand as block", "concat(p_name, ' ', p_size) as name_l", "p_type as addr_l")
    right = part.where("p_partkey % 2 = 1").selectExpr("p_partkey as ein", "p_brand as block", "concat(p_name, ' ', p_size) as name_r", "p_type as addr_r")
    return left, right


_RULES = K.Rules((0.97, 0.50), (0.85, 0.85), (0.75, 0.90))
_PAIRS = """WITH l AS (SELECT p_partkey AS recipient, p_brand AS block, p_name || ' ' || p_size AS name_l, p_type AS addr_l FROM part WHERE p_partkey % 2 = 0),
 r AS (SELECT p_partkey AS ein, p_brand AS block, p_name || ' ' || p_size AS name_r, p_type AS addr_r FROM part WHERE p_partkey % 2 = 1),
 s AS (SELECT recipient, ein, block, 1 - levenshtein(addr_l, addr_r) / greatest(length(addr_l), length(addr_r)) AS addr_score, jaro_winkler_similarity(name_l, name_r) AS name_score FROM l JOIN r USING (block)),
 m AS (SELECT * FROM s WHERE (name_score >= 0.97 AND addr_score >= 0.50) OR (name_score >= 0.85 AND addr_score >= 0.85) OR (name_score >= 0.75 AND addr_score >= 0.90)),
 b AS (SELECT recipient, ein, block FROM (SELECT *, row_number() OVER (PARTITION BY recipient ORDER BY round(2 * name_score + addr_score, 9) DESC, round(name_score, 9) DESC, ein) AS i FROM m) WHERE i = 1)
"""


@query(_PAIRS + "SELECT recipient, ein, block FROM s")
def block_candidate_pairs(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return K.block_pairs(left.select("recipient", "block"), right, "block", "ein").select("recipient", "ein", "block")


@query(_PAIRS + "SELECT recipient, ein, round(addr_score, 9) AS addr_score, round(name_score, 9) AS name_score FROM m")
def fuzzy_match_rules(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return K.candidates(left, right, "block", "name", "addr", _RULES, places=9).select("recipient", "ein", "addr_score", "name_score")


@query(_PAIRS + "SELECT (SELECT count(DISTINCT ein) FROM b) AS n_matched, (SELECT count(*) FROM r) AS n_organisations, round((SELECT count(DISTINCT ein) FROM b) / (SELECT count(*) FROM r), 9) AS share")
def matched_share(spark, sf_dir):
    out = K.matched_share(best_match_per_recipient(spark, sf_dir), "ein", _sides(spark, sf_dir)[1], "ein")
    return out.withColumn("share", F.round("share", 9))


@query(_PAIRS + "SELECT recipient, ein FROM b")
def best_match_per_recipient(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return K.match(left, right, "block", "name", "addr", "recipient", "ein", _RULES).select("recipient", "ein")


@query(_PAIRS + "SELECT l_orderkey, l_linenumber, ein FROM lineitem JOIN b ON l_partkey = recipient")
def match_join_back(spark, sf_dir):
    best = best_match_per_recipient(spark, sf_dir).withColumnRenamed("recipient", "l_partkey")
    return K.join_back(_t(spark, sf_dir, "lineitem"), best, ["l_partkey"]).select("l_orderkey", "l_linenumber", "ein")


@query("SELECT p_partkey, CASE WHEN length(z) < 5 THEN lpad(z, 5, '0') WHEN length(z) = 5 THEN z WHEN length(replace(z, '-', '')) = 9 THEN left(replace(z, '-', ''), 5) END AS zip FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN (10000 + p_partkey) || '-' || lpad(CAST(p_partkey AS VARCHAR), 4, '0') ELSE CAST(100000 + p_partkey AS VARCHAR) END AS z FROM part)")
def zip_clean(spark, sf_dir):
    z = F.expr("case p_partkey % 3 when 0 then cast(p_partkey as string) when 1 then concat(10000 + p_partkey, '-', case when p_partkey < 10000 then lpad(cast(p_partkey as string), 4, '0') else left(cast(p_partkey as string), 4) end) else cast(100000 + p_partkey as string) end")
    return _t(spark, sf_dir, "part").select("p_partkey", S.clean_zip(z).alias("zip"))


@query("""SELECT p_partkey, upper(p_name) || CASE p_partkey % 4 WHEN 0 THEN ' N ' || p_size || ' ST STE' WHEN 1 THEN ' ' || p_size || 'B OHARE ST PO BOX 9 STE' WHEN 2 THEN ' NE ' || p_size || ' LK VW AVE STE' ELSE ' SAINTJEAN RD ' || p_size || '12 STE' END AS address,
 lower(trim(p_name)) AS name_key FROM part""")
def address_normalise(spark, sf_dir):
    second = "case p_partkey % 4 when 0 then concat('North, ', p_size, ' street.') when 1 then concat(p_size, '-B O''Hare Street, P.O. Box 9') when 2 then concat('N.E. ', p_size, '  lake-view avenue') else concat('Saint''Jean Road ', p_size, '/12') end"
    second = second.replace("lake-view", "lake view").replace("N.E.", "NorthEast.")
    parts = [F.concat(F.lit(" "), F.col("p_name")), F.expr(second), F.lit(None).cast("string"), F.lit("(Suite) ")]
    return _t(spark, sf_dir, "part").select("p_partkey", S.clean_address(*parts).alias("address"), S.normalise_name(F.concat(F.lit("  "), F.col("p_name"))).alias("name_key"))


@query("SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P' OR o_orderpriority = '5-LOW') AS no_lineage, count(o_custkey) AS filled_o_custkey FROM orders")
def ingest_quality_report(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").withColumns({"_a": F.nullif("o_orderstatus", F.lit("P")), "_b": F.nullif("o_orderpriority", F.lit("5-LOW"))})
    return Q.measures(rows, ("o_custkey",), ("_a", "_b"))


@query("SELECT event_type, event_id AS run_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS i FROM events) WHERE i = 1")
def latest_run_per_source(spark, sf_dir):
    rows = L.latest_per_key(_t(spark, sf_dir, "events"), ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    return rows.select("event_type", F.col("event_id").alias("run_id"), F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) > 90 THEN 1 ELSE 0 END) AS BIGINT) AS n_warnings FROM events GROUP BY 1")
def validation_warn_count(spark, sf_dir):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(k > 90).alias("n_warnings"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unmatched_anti_not_in(spark, sf_dir):
    return X.not_in(_t(spark, sf_dir, "documents"), "doc_id", _t(spark, sf_dir, "labels").select("doc_id")).select("doc_id", "source")


@query("SELECT c_custkey, CASE WHEN c_custkey IN (SELECT s_suppkey FROM supplier) THEN '990PF' WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN '990' ELSE 'unknown' END AS form FROM customer")
def classify_by_membership(spark, sf_dir):
    forms = {"990": _t(spark, sf_dir, "orders").select("o_custkey"), "990PF": _t(spark, sf_dir, "supplier").select("s_suppkey")}
    return X.classify(_t(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", forms)


@query("SELECT source, count(*) AS n_missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1")
def missing_grants_by_funder(spark, sf_dir):
    return X.missing_by_funder(unmatched_anti_not_in(spark, sf_dir), "source")


_COUNTS = "WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1), k AS (SELECT ps AS l_partkey, m FROM (SELECT l_partkey AS ps, count(*) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1))"


@query(_COUNTS + " SELECT l_partkey, n, m, n = 1 AS singleton FROM c JOIN k USING (l_partkey)")
def singleton_vs_multiple(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    counts, labelled = rows.groupBy("l_partkey").agg(F.count("*").alias("n")), rows.where("l_returnflag = 'R'").groupBy("l_partkey").agg(F.count("*").alias("m"))
    single, multiple = X.singletons_and_multiples(counts, labelled, "l_partkey", "n", "m")
    return single.withColumn("singleton", F.lit(True)).unionByName(multiple.withColumn("singleton", F.lit(False)))


@query("SELECT c_custkey, o_orderkey AS original_o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def missing_original_rows(spark, sf_dir):
    missing = X.not_in(_t(spark, sf_dir, "customer"), "c_custkey", _t(spark, sf_dir, "supplier").select("s_suppkey"))
    return X.original_rows(missing.select("c_custkey"), "c_custkey", _t(spark, sf_dir, "orders"), "o_custkey").select("c_custkey", "original_o_orderkey")


@query("SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_totalprice > 300000) AS total FROM orders WHERE o_totalprice > 300000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def page_with_total_count(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_orderkey", "o_totalprice")
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25).join(F.broadcast(total), how="cross")  # one row: a count


@query(f"SELECT coalesce(n.ein, f.ein) AS ein, coalesce(n.name, f.name) AS name, CASE WHEN n.name IS NOT NULL THEN 'nonprofit' ELSE 'foundation' END AS org_type FROM (SELECT c_custkey AS ein, c_name AS name FROM customer WHERE {_CHARITIES}) n FULL JOIN (SELECT c_custkey AS ein, 'Fund ' || c_name AS name FROM customer WHERE {_FUNDS}) f ON n.ein = f.ein")
def org_profile_identity(spark, sf_dir):
    extra = {"city": F.lit("x"), "state": F.lit("y")}
    out = X.profile(nonprofits(spark, sf_dir).withColumns(extra), funders(spark, sf_dir).withColumns(extra))
    return out.select(F.col("ein").cast("bigint").alias("ein"), "name", "org_type")
