"""Queries of whole tables and pages: the shared tables dressed as filings, so that canonical tables, matching, search and
profiles run as they do on a catalog. Customers file by their segment, orders are their filings, documents their
narratives, parts both payees and organisations."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantlake.functions import textsearch as T
from grantlake.plans import canonical as C
from grantlake.plans import explorer as X
from grantlake.plans import matching as M
from grantlake.plans.client import Client
from grantlake.queries import _CHARITIES, _FUNDS, _TOK, STEMS, _t, query

# Expressions that both engines read alike.
_FILED = [
    "lpad(cast(o_custkey as string), 9, '0') as filerein", "cast(year(o_orderdate) as string) as taxyear", "lpad(cast(o_orderkey as string), 12, '0') as taxperend", "c_name || ' ' || o_orderpriority as filername1",
    "case when o_orderstatus = 'P' then 'Friends' end as filername2", "'dba ' || c_mktsegment as dbanbnline11", "cast(null as string) as dbanbnline22", "cast(null as string) as incarenm", "o_orderkey || ' Main St' as filerus1",
    "cast(null as string) as filerus2", "c_mktsegment as fileruscity", "cast(c_nationkey as string) as filerusstate", "lpad(cast(c_nationkey as string), 5, '0') as fileruszip", "cast(null as string) as filerforctry",
    "'http://' || o_custkey as websitsiteit", "cast(null as string) as formationorm", "cast(null as string) as filerphone", "'u' || o_orderkey as url", "case o_orderstatus when 'P' then 'true' when 'F' then '0' end as donoadvifund",
    "cast(cast(floor(o_totalprice) as bigint) as string) as totrevcuryea", "cast(cast(floor(o_totalprice / 2) as bigint) as string) as totacashcont", "case when o_orderstatus = 'F' then '1000' else '' end as governgrants",
    "'7' as federacampai", "'' as memberduesue", "'3.9' as fundraevents", "'x' as relateorgani", "cast(null as string) as alloothecont", "'-5' as noncascontri",
    "cast(cast(floor(o_totalprice / 3) as bigint) as string) as areterexpnss", "cast(cast(floor(o_totalprice / 4) as bigint) as string) as anreextoreex", "'11' as arecrrexpnss",
    "' ' || o_orderpriority || ' ' as sudichacdees1", "cast(o_orderkey as string) as sudichacexxp1", "' ' as sudichacdees2", "'0' as sudichacexxp2", "cast(null as string) as sudichacdees3", "case when o_orderstatus = 'F' then '21' end as sudichacexxp3",
    "cast(null as string) as sudichacdees4", "cast(null as string) as sudichacexxp4", "case when o_orderstatus = 'O' then 'loan' end as suprreindees1", "'40' as suprreinammo1", "cast(null as string) as suprreindees2", "'' as suprreinammo2",
    "case when o_orderstatus = 'P' then '6' end as spriaopritot", "case when o_orderstatus = 'F' then '99' end as suprreintoot", "'1' as _ingested_at", "'run' as _ingest_run_id", "'v1' as _source_version",
]
_MISSION = ["lpad(cast(doc_id as string), 9, '0') as filerein", "case when source <> 'src3' then cast(2000 + doc_id % 20 as string) end as taxyear", "text as mission"]
_PROGRAM = ["lpad(cast(p_partkey as string), 9, '0') as filerein", "cast(2000 + p_size as string) as taxyear", "p_name as actividescri1", "case when p_size > 25 then p_type else ' ' end as actividescri2", "nullif(p_brand, 'Brand#7') as actividescri3"]
_TURN = ["lpad(cast(conv_id as string), 9, '0') as filerein", "cast(2000 + turn as string) as taxyear", "'FORM 990, PART III' as sidfalrdesc", "text as supinfdetexp"]

_FILINGS = f"""bf AS (SELECT {', '.join(_FILED)} FROM customer JOIN orders ON c_custkey = o_custkey WHERE {_CHARITIES}),
 pf AS (SELECT {', '.join(_FILED)} FROM customer JOIN orders ON c_custkey = o_custkey WHERE {_FUNDS})"""
_NARRATIVES = f"ms AS (SELECT {', '.join(_MISSION)} FROM documents), pr AS (SELECT {', '.join(_PROGRAM)} FROM part), so AS (SELECT {', '.join(_TURN)} FROM conversations)"
_LATEST = "(SELECT *, row_number() OVER (PARTITION BY filerein ORDER BY CAST(taxyear AS INT) DESC, taxperend DESC) AS i FROM {0}) WHERE i = 1"


def tables(spark, sf_dir):
    """Tables by the names that a catalog gives them."""
    t = lambda name: _t(spark, sf_dir, name)
    filed = lambda condition: t("customer").where(condition).join(t("orders"), F.col("c_custkey") == F.col("o_custkey")).selectExpr(*_FILED)
    made = {
        "basic_fields": lambda: filed(_CHARITIES),
        "basic_fields_pf": lambda: filed(_FUNDS),
        "mission_statements": lambda: t("documents").selectExpr(*_MISSION),
        "programs": lambda: t("part").selectExpr(*_PROGRAM),
        "schedule_o": lambda: t("conversations").selectExpr(*_TURN),
        "schedule_o_part_iii": lambda: C.schedule_o_part_iii(made["schedule_o"]()),
        "nonprofit_canonical": lambda: C.nonprofit_canonical(made["basic_fields"]()),
        "funder_canonical": lambda: C.funder_canonical(made["basic_fields_pf"]()),
        "nonprofit_text": lambda: T.english(made["mission_statements"]().select(F.col("filerein").alias("ein"), F.col("mission").alias("unique_text_compact"), T.tokens(F.col("mission")).alias("tokens_english")), "ein", "tokens_english"),
        "nonprofit_index_english": lambda: T.inverted_index(made["nonprofit_text"](), "ein", "tokens_english"),
        "nonprofit_index_simple": lambda: T.inverted_index(made["mission_statements"]().select(F.col("filerein").alias("ein"), T.tokens(F.col("mission")).alias("doc")), "ein", "doc"),
    }
    return lambda name: made[name]()


@query(f"WITH {_FILINGS} SELECT filerein AS ein, filername1 AS name, filername2 AS name_secondary, dbanbnline11 AS dba_1, filerus1 AS addr_line_1, fileruscity AS city, filerusstate AS state, fileruszip AS zip, websitsiteit AS website, taxyear AS latest_taxyear, taxperend AS latest_taxperend, _ingest_run_id AS source_run_id FROM {_LATEST.format('bf')}")
def nonprofit_identity(spark, sf_dir):
    return tables(spark, sf_dir)("nonprofit_canonical").select("ein", "name", "name_secondary", "dba_1", "addr_line_1", "city", "state", "zip", "website", "latest_taxyear", "latest_taxperend", "source_run_id")


@query(f"WITH {_FILINGS} SELECT filerein AS ein, filername1 AS name, filerus1 AS addr_line_1, city, latest_taxyear FROM (SELECT *, fileruscity AS city, taxyear AS latest_taxyear FROM {_LATEST.format('pf')})")
def funder_identity(spark, sf_dir):
    return tables(spark, sf_dir)("funder_canonical").select("ein", "name", "addr_line_1", "city", "latest_taxyear")


_FAN = f"""{_NARRATIVES}, fan AS (SELECT filerein AS ein, CAST(taxyear AS INT) AS y, mission AS txt FROM ms UNION ALL SELECT filerein, CAST(taxyear AS INT), unnest([actividescri1, actividescri2, actividescri3]) FROM pr
 UNION ALL SELECT filerein, CAST(taxyear AS INT), supinfdetexp FROM so)"""


@query(f"""WITH {_FAN} SELECT ein, string_agg(txt, chr(10) || chr(10) ORDER BY txt) AS unique_text_compact, count(*) AS n_snippets FROM (SELECT DISTINCT ein, txt FROM
 (SELECT *, dense_rank() OVER (PARTITION BY ein ORDER BY y DESC NULLS LAST) AS i FROM fan WHERE coalesce(txt, '') <> '') WHERE i = 1) GROUP BY 1""")
def nonprofit_narratives(spark, sf_dir):
    t = tables(spark, sf_dir)
    return C.nonprofit_text(t("mission_statements"), t("programs"), t("schedule_o_part_iii")).drop("_built_at")


_OFFICER = ["cast(c_nationkey as string) as filerein", "cast(2000 + c_custkey % 9 as string) as taxyear", "'12' as taxperend", "c_name as namepeperson", "c_mktsegment as titleitle", "cast(c_custkey as string) as avehouperwee", "'' as avhopewereel",
            "'1.5' as repcomfroorg", "'x' as recofrrlorrg", "cast(null as string) as otherccompen", "'X' as officerffice", "'' as inditrusdire", "cast(null as string) as instittruste", "'X' as keyempemploy", "'' as highcompempl", "'X' as formerormer", "'v' as _source_version", "'r' as _ingest_run_id"]
_OFFICER_PF = ["cast(s_nationkey as string) as filerein", "cast(2000 + s_suppkey % 9 as string) as taxyear", "'12' as taxperend", "s_name as odtkeiodtokepn", "'Trustee' as odtkeiodtoketi", "cast(s_suppkey as string) as odtkeiodtoke", "'7' as odtkeiodtokecom", "'2' as odtkeiodtokecoeb", "cast(null as string) as odtkeiodtokeeao", "'v' as _source_version", "'r' as _ingest_run_id"]


@query("""SELECT CAST(c_nationkey AS VARCHAR) AS ein, c_mktsegment AS title, CAST(c_custkey AS DOUBLE) AS hours, CAST(NULL AS DOUBLE) AS other, true AS is_officer, false AS is_individual_trustee, '990' AS source_form FROM customer
 UNION ALL SELECT CAST(s_nationkey AS VARCHAR), 'Trustee', CAST(s_suppkey AS DOUBLE), 2, NULL, NULL, '990-PF' FROM supplier""")
def person_roles(spark, sf_dir):
    roles = C.org_person_role(_t(spark, sf_dir, "customer").selectExpr(*_OFFICER), _t(spark, sf_dir, "supplier").selectExpr(*_OFFICER_PF))
    return roles.select("ein", "title", F.col("avg_hours_per_week").cast("double").alias("hours"), F.col("comp_other").cast("double").alias("other"), "is_officer", "is_individual_trustee", "source_form")


# Payees spell a name without its last letter now and then, and lack a state or a ZIP where it is one size.
_PAYEE = ["lpad(cast(p_partkey as string), 9, '0') as filerein", "'Fund' as filername1", "cast(null as string) as filername2", "md5(cast(p_partkey as string)) as filesha256", "'u' as url", "cast(2010 + p_partkey % 12 as string) as taxyear", "cast(null as string) as taxperbegin",
          "cast(null as string) as taxperend", "cast(null as string) as sigocpyrpnam", "left(p_name, length(p_name) - p_partkey % 2) || ' ' || p_size as sigocpyrbnbn1", "cast(null as string) as sigocpyrbnbn2", "p_type || ' Street' as sigocpyrfaal1", "cast(null as string) as sigocpyrfaal2",
          "p_brand as sigocpyrfaci", "case when p_size <> 7 then 'NY' end as sigocpyrfapo", "case when p_size <> 9 then cast(10000 + p_size as string) || '-0001' end as sigocpyrfapc", "cast(p_size as string) as sigocpyamoun", "'p' as sigocpypogoc", "cast(null as string) as sigocpyrfsta", "cast(null as string) as sigocpyrrela"]
_ORG = ["lpad(cast(p_partkey as string), 9, '0') as filerein", "'2020' as taxyear", "upper(p_name) || ' ' || p_size as filername1", "cast(null as string) as filername2", "p_type || ' ST.' as filerus1", "cast(null as string) as filerus2", "p_brand as fileruscity", "'NY' as filerusstate", "cast(10000 + p_size as string) as fileruszip"]
_RULES = " OR ".join(f"(name_score >= {n} AND addr_score >= {a})" for n, a in M.STRICT.pairs())
_MATCHED = f"""WITH pg AS (SELECT {', '.join(_PAYEE)} FROM part), og AS (SELECT {', '.join(_ORG)} FROM part),
 lk AS (SELECT *, lower(sigocpyrbnbn1) AS n1, lower(sigocpyrfaal1) AS a1, lower(sigocpyrfaci) AS ci, lower(sigocpyrfapo) AS st, left(sigocpyrfapc, 5) AS zip FROM pg),
 l AS (SELECT DISTINCT n1, a1, ci, st, zip, replace(upper(a1), ' STREET', ' ST') || ' ' || replace(upper(ci), '#', '') || ' NY' AS addr_l FROM lk WHERE CAST(taxyear AS INT) >= 2015 AND st IS NOT NULL AND zip IS NOT NULL),
 r AS (SELECT filerein AS ein, lower(filername1) AS name_r, replace(upper(filerus1), '.', '') || ' ' || replace(upper(fileruscity), '#', '') || ' NY' AS addr_r, fileruszip AS zip FROM og),
 s AS (SELECT l.*, ein, 1 - levenshtein(addr_l, addr_r) / greatest(length(addr_l), length(addr_r)) AS addr_score, jaro_winkler_similarity(n1, name_r) AS name_score FROM l JOIN r USING (zip)),
 b AS (SELECT n1, a1, ci, st, zip, ein FROM (SELECT *, row_number() OVER (PARTITION BY n1, a1, ci, st, zip ORDER BY round(2 * name_score + addr_score, 9) DESC, round(name_score, 9) DESC, ein) AS i FROM s WHERE {_RULES}) WHERE i = 1)
"""


@query(_MATCHED + "SELECT ein AS recipeint_ein_key, n1 AS name1_key, '' AS name2_key, a1 AS address1_key, '' AS address2_key, ci AS addresscity_key, st AS addressstate_key, zip AS addresszip_key FROM b")
def match_recipients_full(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return M.match_recipients(part.selectExpr(*_PAYEE), part.selectExpr(*_ORG))


_GIVEN = ["lpad(cast(s_suppkey as string), 9, '0') as filerein", "s_name as filername1", "cast(null as string) as filername2", "'v' as url", "'2019' as taxyear", "cast(null as string) as taxperbegin", "cast(null as string) as taxperend", "lpad(cast(s_nationkey as string), 9, '0') as rteinorecipi", "'Rec' as rtrnbbnline11",
          "cast(null as string) as rtrnbbnline22", "cast(null as string) as retaadadliin1", "cast(null as string) as retaadadliin2", "cast(null as string) as rectabaddcit", "cast(null as string) as rectabaddsta", "cast(null as string) as rtazipcode", "cast(cast(floor(s_acctbal) as bigint) as string) as retaamofcagr", "'q' as retapuofgrra"]


@query(_MATCHED + f""", j AS (SELECT lk.*, ein FROM lk JOIN b USING (n1, a1, ci, st, zip))
 SELECT DISTINCT filerein AS granter_ein, filesha256, CAST(taxyear AS INT) AS taxyear, ein AS grantee_ein, sigocpyrbnbn1 AS grantee_organization_name1, CAST(sigocpyamoun AS BIGINT) AS grant_amount, sigocpypogoc AS grant_purpose FROM j
 UNION SELECT filerein, NULL, CAST(taxyear AS INT), rteinorecipi, rtrnbbnline11, CAST(retaamofcagr AS BIGINT), retapuofgrra FROM (SELECT {', '.join(_GIVEN)} FROM supplier)""")
def grants_of_both_forms(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    matched = M.grants_with_recipients(part.selectExpr(*_PAYEE), part.selectExpr(*_ORG))
    return C.unioned_grants(matched, _t(spark, sf_dir, "supplier").selectExpr(*_GIVEN)).select("granter_ein", "filesha256", "taxyear", "grantee_ein", "grantee_organization_name1", "grant_amount", "grant_purpose")


_HITS = "len(list_filter(w, lambda x: regexp_full_match(x, '" + STEMS["onth"] + "')))"


@query(f"""{_TOK}, {_FILINGS}, c AS (SELECT filerein AS ein, filername1 AS name FROM {_LATEST.format('bf')}), h AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS ein, {_HITS} AS n FROM d),
 e AS (SELECT filerein AS ein FROM (SELECT filerein, sum(CAST(totacashcont AS BIGINT)) AS s FROM bf WHERE CAST(taxyear AS INT) >= 1996 GROUP BY filerein, taxyear) GROUP BY 1 HAVING avg(s) >= 150000)
 SELECT ein, name, round(0.1 / 1.64493406685 * list_aggregate(list_transform(range(1, 1 + least(256, n)), lambda j: 1.0 / (j * j)), 'sum'), 9) AS rank FROM h LEFT JOIN c USING (ein) WHERE n > 0 AND ein IN (SELECT ein FROM e)""")
def client_search(spark, sf_dir):
    found = Client(spark, tables(spark, sf_dir)).search_nonprofits(["onthing"], min_avg_contributions=150_000, min_taxyear=1996)
    return found.select("ein", "name", F.round("rank", 9).alias("rank"))


@query(f"WITH {_FILINGS}, c AS (SELECT * FROM {_LATEST.format('bf')}) SELECT filerein AS ein, filername1 AS name, text AS unique_text_compact FROM c LEFT JOIN documents ON lpad(CAST(doc_id AS VARCHAR), 9, '0') = filerein WHERE filerein = (SELECT min(filerein) FROM c)")
def client_nonprofit(spark, sf_dir):
    t = tables(spark, sf_dir)
    first = t("basic_fields").agg(F.min("filerein")).first()[0]
    return Client(spark, t).get_nonprofit(first).select("ein", "name", "unique_text_compact")


@query(f"""WITH {_FILINGS} SELECT filerein AS ein, CAST(taxyear AS INT) AS taxyear, CAST(totrevcuryea AS BIGINT) AS total_revenue_current_year, CAST(totacashcont AS BIGINT) AS total_cash_contributions,
 CAST(totacashcont AS BIGINT) - CASE WHEN governgrants = '1000' THEN 1000 ELSE 0 END AS total_cash_contributions_no_gov FROM bf WHERE filerein IN ('000000004', '000000007', '000000010', '000000021') AND CAST(taxyear AS INT) >= 1994""")
def client_basic_fields(spark, sf_dir):
    out = Client(spark, tables(spark, sf_dir)).get_basic_fields(["000000004", "000000007", "000000010", "000000021"], min_taxyear=1994)
    return out.select("ein", "taxyear", "total_revenue_current_year", "total_cash_contributions", "total_cash_contributions_no_gov")


_ARMS = f"""{_TOK}, {_FILINGS}, a AS (SELECT filerein AS ein, filername1 AS name1, CAST(taxyear AS INT) AS last_year, 'nonprofit' AS org_type FROM {_LATEST.format('bf')}), b AS (SELECT filerein AS ein, filername1 AS name1, CAST(taxyear AS INT) AS last_year, 'foundation' AS org_type FROM {_LATEST.format('pf')}),
 h AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS ein, {_HITS} AS n FROM d)"""


@query(_ARMS + """, m AS (SELECT a.*, round(0.1 * n, 6) AS rank FROM a JOIN h USING (ein) WHERE n > 0), f AS (SELECT filerein AS ein, CAST(min(CAST(taxyear AS INT)) AS INT) AS first_year FROM bf GROUP BY 1)
 SELECT m.*, first_year, (SELECT count(*) FROM m) AS total FROM m JOIN f USING (ein) ORDER BY rank DESC, last_year DESC, name1, ein LIMIT 10 OFFSET 10""")
def run_search_narrative(spark, sf_dir):
    page = X.run_search(tables(spark, sf_dir), " onths ", page=2, limit=10)
    return page.select("ein", "name1", "last_year", "org_type", F.round("rank", 6).alias("rank"), "first_year", "total")


@query(_ARMS + """, m AS (SELECT *, CASE WHEN ein = '000000042' THEN 2e6 ELSE 1e6 END AS rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE ein = '000000042' OR name1 ILIKE '%000000042%'),
 f AS (SELECT 'nonprofit' AS org_type, filerein AS ein, CAST(min(CAST(taxyear AS INT)) AS INT) AS first_year FROM bf GROUP BY 2 UNION ALL SELECT 'foundation', filerein, CAST(min(CAST(taxyear AS INT)) AS INT) FROM pf GROUP BY 2)
 SELECT ein, name1, last_year, org_type, rank, first_year, (SELECT count(*) FROM m) AS total FROM m JOIN f USING (org_type, ein) ORDER BY rank DESC, last_year DESC, name1, ein LIMIT 25""")
def run_search_ein(spark, sf_dir):
    page = X.run_search(tables(spark, sf_dir), "00-0000042", mode="name", limit="no number")
    return page.select("ein", "name1", "last_year", "org_type", "rank", "first_year", "total")


@query(_ARMS + """, m AS (SELECT a.*, 1e6 AS rank FROM a WHERE name1 ILIKE '%5-low%' AND ein IN (SELECT filerein FROM bf WHERE donoadvifund = 'true')), f AS (SELECT filerein AS ein, CAST(min(CAST(taxyear AS INT)) AS INT) AS first_year FROM bf GROUP BY 1)
 SELECT m.*, first_year, (SELECT count(*) FROM m) AS total FROM m JOIN f USING (ein) ORDER BY rank DESC, last_year DESC, name1, ein LIMIT 50""")
def run_search_donor_funds(spark, sf_dir):
    page = X.run_search(tables(spark, sf_dir), "5-LOW", mode="name", limit=500, daf_only=True)
    return page.select("ein", "name1", "last_year", "org_type", "rank", "first_year", "total")


@query(f"""WITH {_FILINGS} SELECT filerein AS ein, CAST(taxyear AS INT) AS taxyear, url, CAST(totrevcuryea AS BIGINT) AS total_revenue, CAST(totacashcont AS BIGINT) AS total_contributions, CAST(7 AS BIGINT) AS federated_campaigns, CAST(3 AS BIGINT) AS fundraising_events,
 CAST(NULL AS BIGINT) AS related_organizations, CAST(nullif(governgrants, '') AS BIGINT) AS government_grants, CAST(-5 AS BIGINT) AS non_cash_contributions FROM bf
 UNION ALL SELECT filerein, CAST(taxyear AS INT), url, CAST(anreextoreex AS BIGINT), CAST(11 AS BIGINT), NULL, NULL, NULL, NULL, NULL FROM pf""")
def revenue_details(spark, sf_dir):
    t = tables(spark, sf_dir)
    rows = X.revenue_details(t("basic_fields"), "nonprofit").unionByName(X.revenue_details(t("basic_fields_pf"), "foundation"))
    return rows.select("ein", "taxyear", "url", "total_revenue", "total_contributions", "federated_campaigns", "fundraising_events", "related_organizations", "government_grants", "non_cash_contributions")


@query(f"""WITH {_FILINGS}, v AS (SELECT filerein AS ein, CAST(taxyear AS INT) AS taxyear, CAST(totrevcuryea AS BIGINT) AS revenue FROM bf)
 SELECT *, round(CASE WHEN max(revenue) OVER (PARTITION BY ein) > 0 THEN greatest(4.0, 56.0 * revenue / max(revenue) OVER (PARTITION BY ein)) ELSE 4 END, 6) AS height FROM v""")
def revenue_bars(spark, sf_dir):
    rows = tables(spark, sf_dir)("basic_fields").select(F.col("filerein").alias("ein"), F.col("taxyear").cast("int").alias("taxyear"), F.col("totrevcuryea").cast("bigint").alias("revenue"))
    return X.with_bars(rows).withColumn("height", F.round("height", 6))


_ACTIVE = """SELECT filerein AS ein, CAST(taxyear AS INT) AS taxyear, trim(sudichacdees1) AS first_activity, 1 + CAST(sudichacexxp3 IS NOT NULL AS INT) AS n_activities, CAST(sudichacexxp1 AS BIGINT) + coalesce(CAST(sudichacexxp3 AS BIGINT), 0) AS direct,
 CAST(coalesce(CAST(suprreintoot AS BIGINT), 40 + coalesce(CAST(spriaopritot AS BIGINT), 0)) AS BIGINT) AS invested FROM pf"""


@query(f"WITH {_FILINGS} {_ACTIVE}")
def foundation_activities(spark, sf_dir):
    rows = X.foundation_activities(tables(spark, sf_dir)("basic_fields_pf"))
    return rows.select("ein", "taxyear", F.col("charitable")[0]["description"].alias("first_activity"), F.size("charitable").alias("n_activities"), "direct", "invested")


_JOINED = "md5(coalesce(string_agg({0}, '|' ORDER BY CAST(taxyear AS INT) DESC NULLS FIRST{1}), ''))"


@query(f"""WITH {_FILINGS}, {_NARRATIVES}, ca AS (SELECT * FROM {_LATEST.format('bf')}), cb AS (SELECT * FROM {_LATEST.format('pf')}),
 ra AS (SELECT filerein, CAST(min(CAST(taxyear AS INT)) AS INT) AS first_year, CAST(max(CAST(taxyear AS INT)) AS INT) AS last_year, CAST(sum(CAST(totrevcuryea AS BIGINT)) AS BIGINT) AS revenue, count(*) AS n_years, bool_or(donoadvifund = 'true') AS daf, count(DISTINCT taxyear) AS n_daf,
  md5(string_agg(totrevcuryea, '|' ORDER BY CAST(taxyear AS INT), CAST(totrevcuryea AS BIGINT))) AS revenues FROM bf GROUP BY 1),
 rb AS (SELECT filerein, CAST(min(CAST(taxyear AS INT)) AS INT) AS first_year, CAST(max(CAST(taxyear AS INT)) AS INT) AS last_year, CAST(sum(CAST(areterexpnss AS BIGINT)) AS BIGINT) AS revenue, count(*) AS n_years, false AS daf, 0 AS n_daf,
  md5(string_agg(areterexpnss, '|' ORDER BY CAST(taxyear AS INT), CAST(areterexpnss AS BIGINT))) AS revenues FROM pf WHERE filerein NOT IN (SELECT filerein FROM bf) GROUP BY 1),
 m AS (SELECT filerein, {_JOINED.format('mission', '')} AS missions FROM ms WHERE coalesce(mission, '') <> '' GROUP BY 1), s AS (SELECT filerein, {_JOINED.format('supinfdetexp', ', supinfdetexp')} AS schedule_o FROM so WHERE coalesce(supinfdetexp, '') <> '' GROUP BY 1),
 p AS (SELECT filerein, {_JOINED.format('x', ', i')} AS programs FROM (SELECT filerein, taxyear, unnest([actividescri1, actividescri2, actividescri3]) AS x, unnest([0, 1, 2]) AS i FROM pr) WHERE coalesce(trim(x), '') <> '' GROUP BY 1), none AS (SELECT md5('') AS e)
 SELECT filerein AS ein, 'nonprofit' AS org_type, filername1 AS name, first_year, last_year, revenue, CAST(n_years AS INT) AS n_years, coalesce(daf, false) AS has_daf, CAST(n_daf AS INT) AS n_daf, revenues, coalesce(missions, e) AS missions, coalesce(programs, e) AS programs, coalesce(schedule_o, e) AS schedule_o, 0 AS n_activities
  FROM ra JOIN ca USING (filerein) LEFT JOIN m USING (filerein) LEFT JOIN p USING (filerein) LEFT JOIN s USING (filerein), none
 UNION ALL SELECT filerein, 'foundation', filername1, first_year, last_year, revenue, CAST(n_years AS INT), daf, n_daf, revenues, e, e, e, CAST(n_years AS INT) FROM rb JOIN cb USING (filerein), none""")
def org_profile_full(spark, sf_dir):
    texts = lambda c: F.md5(F.coalesce(F.array_join(F.transform(c, lambda x: x["text"]), "|"), F.lit("")))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    revenues = F.md5(F.array_join(F.transform("revenue_by_year", lambda x: x["revenue"].cast("string")), "|"))
    return X.org_profile(tables(spark, sf_dir)).select(
        "ein", "org_type", "name", "first_year", "last_year", "revenue", size(F.col("revenue_details")).alias("n_years"), "has_daf", size(F.col("daf_by_year")).alias("n_daf"), revenues.alias("revenues"),
        *[texts(F.col(c)).alias(c) for c in ("missions", "programs", "schedule_o")], size(F.col("activities")).alias("n_activities"),
    )
