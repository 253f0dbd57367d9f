import random
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grantlake.functions import scalars as S
from grantlake.functions import textsearch as T
from grantlake.functions.porter2 import stem
from grantlake.operators import grants as G
from grantlake.operators import latest as L
from grantlake.operators import linkage as K
from grantlake.operators import quality as Q
from grantlake.operators.similarity import Texts
from grantlake.plans import canonical as C
from grantlake.plans import explorer as X
from grantlake.plans.catalog import Catalog
from grantlake.plans.cli import main
from grantlake.plans.client import Client
from grantlake.plans.matching import _sides, grants_with_recipients, match_recipients, stage_one
from grantlake.sources import registry as R
from grantlake.streaming.arrivals import arrivals, load_arrived


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_scalars(spark):
    lit = F.lit
    assert one(spark, S.to_int(lit("")), S.to_int(lit("12")), S.to_long(lit("x")), S.leading_int(lit("12.9")), S.leading_int(lit("abc"))) == (None, 12, None, 12, None)
    assert str(one(spark, S.to_decimal(lit("0.30")))[0]) == "0.3000000000"
    assert one(spark, *[S.clean_zip(lit(z)) for z in ("", "123", "12345", "12345-6789", "123456")]) == ("00000", "00123", "12345", "12345", None)
    assert one(spark, S.full_name(lit(" A "), lit(None), lit("B"))) == ("A B",)
    assert one(spark, S.clean_address(lit("1 Main Street."), lit(None), lit("Lake Falls"), lit("ny"))) == ("1 MAIN ST LK FLS NY",)
    assert one(spark, *[S.round_away(lit(x)) for x in (0.5, 1.5, -0.5, -2.5)]) == (1, 2, -1, -3)
    assert one(spark, S.format_ein(lit("131234567")), S.as_ein(lit("13-1234567")), S.format_compact(lit(-1_230_000)), S.format_full(lit(None).cast("bigint"))) == ("13-1234567", "131234567", "-$1.2M", "—")
    assert one(spark, S.person_key(lit(" Ann  Lee"), lit("1")) == S.person_key(lit("ann lee"), lit("1"))) == (True,)
    assert one(spark, S.compare(lit(5), ">=", 5), S.compare(lit(None).cast("int"), "<", 9), S.any_ilike("a%c", lit("xABCx"))) == (True, False, True)
    assert (S.Clean.page("x"), S.Clean.limit(0), S.Clean.limit(900, 100), S.Clean.year(1800), S.Clean.amount("-1"), S.Clean.query("  q " * 99)[:1]) == (1, 25, 100, None, None, "q")


def test_latest_and_best(spark):
    rows = [("a", "2020", "x", "1"), ("a", "2021", None, "2"), ("a", "2021", "y", "3"), ("b", None, None, "4"), ("b", None, "z", "5")]
    df = spark.createDataFrame(rows, "filerein string, taxyear string, taxperend string, _ingested_at string")
    got = L.latest_per_key(df, ["filerein"], L.filing_order(S.to_int(F.col("taxyear")), "taxperend", "_ingested_at")).collect()
    assert {r.filerein: r._ingested_at for r in got} == {"a": "3", "b": "5"}
    assert sorted(r._ingested_at for r in L.latest_group(df, ["filerein"], S.to_int(F.col("taxyear"))).collect()) == ["2", "3", "4", "5"]
    with pytest.raises(ValueError):
        L.assert_unique(df, ["filerein"])
    pairs = spark.createDataFrame([(1, "b", 0.9, 0.8), (1, "a", 0.9, 0.8), (1, "c", 0.8, 1.0)], "r int, ein string, name_score double, addr_score double")
    assert [r.ein for r in L.best_match(pairs, "r").collect()] == ["a"]


def test_jaro_winkler_equals_the_oracle(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 12)))
    pairs = [(word(), word()) for _ in range(400)] + [("martha", "marhta"), ("", "a"), ("a", "a")]
    for a, b in pairs:
        want = duckdb.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchall()[0][0] if a and b else 0.0
        assert abs(K.jaro_winkler(a, b) - want) < 1e-12, (a, b)
    df = spark.createDataFrame([("", ""), ("abc", "abd"), (None, "a")], "a string, b string")
    assert [round(r[0], 3) for r in df.select(K.edit_similarity(F.col("a"), F.col("b"))).collect()] == [0.0, 0.667, 0.0]


def frame(spark, names, rows):
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))


def grant_fixture(spark):
    pg = "filerein filername1 filername2 filesha256 url taxyear taxperbegin taxperend sigocpyrpnam sigocpyrbnbn1 sigocpyrbnbn2 sigocpyrfaal1 sigocpyrfaal2 sigocpyrfaci sigocpyrfapo sigocpyrfapc sigocpyamoun sigocpypogoc sigocpyrfsta sigocpyrrela"
    g = lambda name, street, zipcode="10001", year="2020", city="New York", amount="5": ("F1", "Fund", None, "sha", "u", year, None, None, None, name, None, street, None, city, "NY", zipcode, amount, "p", None, None)
    private = frame(spark, pg, [g("Hope House", "1 Main Street"), g("Hope House", "1 Main Street"), g("Hope Hous", "1 Main St."), g("Other Org", "9 Far Road"), g("Hope House", "1 Main Street", None), g("Hope House", "1 Main Street", city=None), g("Hope House", "1 Main Street", year="2001"), g("Old Only", "1 Main Street", year="2001")])
    basic = frame(spark, "filerein filername1 filername2 filerus1 filerus2 fileruscity filerusstate fileruszip taxyear", [("111", "HOPE HOUSE", None, "1 Main St", None, "New York", "NY", "10001-2345", "2019"), ("110", "HOPE HOUSE", None, "1 Main St", None, "New York", "NY", "10001", "2018"), ("222", "Elsewhere", None, "1 Main St", None, "Albany", "NY", "12201", "2019")])
    return private, basic


def test_matching_traps(spark):
    private, basic = grant_fixture(spark)
    mapping = match_recipients(private, basic).collect()
    assert {(r.name1_key, r.recipeint_ein_key) for r in mapping} == {("hope house", "110"), ("hope hous", "110")}
    out = grants_with_recipients(private, basic).collect()
    # Both equal lines, the misspelt one and the old one whose keys recur join back; null ZIP and city never do.
    assert sorted((r.sigocpyrbnbn1, r.taxyear) for r in out) == [("Hope Hous", "2020"), ("Hope House", "2001"), ("Hope House", "2020"), ("Hope House", "2020")]
    strict = {(r.recipient, r.filerein_key) for r in stage_one(private, basic, K.STRICT).collect()}
    assert strict <= {(r.recipient, r.filerein_key) for r in stage_one(private, basic).collect()}
    schedule = frame(spark, "filerein filername1 filername2 url taxyear taxperbegin taxperend rteinorecipi rtrnbbnline11 rtrnbbnline22 retaadadliin1 retaadadliin2 rectabaddcit rectabaddsta rtazipcode retaamofcagr retapuofgrra", [("N1", "Non", None, "u", "2020", "2020-01-01", None, None, "Rec", None, None, None, None, None, None, "7", "q")] * 2)
    grants = C.unioned_grants(grants_with_recipients(private, basic), schedule)
    assert grants.count() == 4 and grants.where("grantee_ein is null").count() == 1 and len(grants.columns) == 21
    assert C.unioned_grants(grants_with_recipients(private, basic), schedule).unionByName(grants).distinct().count() == 4


def test_grant_analytics(spark):
    rows = [("1", "A", None, "s", "9", "X", 2020, 10, "p"), ("1", "A", None, None, None, "Y", 2021, None, "p"), ("2", "B", None, None, "9", "Z", 2021, 15, "q")]
    g = spark.createDataFrame(rows, "granter_ein string, granter_name string, granter_name2 string, filesha256 string, grantee_ein string, grantee_organization_name1 string, taxyear int, grant_amount long, grant_purpose string").withColumns({"grantee_organization_name2": F.lit(None).cast("string"), "grantee_person_name": F.lit(None).cast("string")})
    n, f = spark.createDataFrame([("1", "Non"), ("9", "Nine")], "ein string, name string"), spark.createDataFrame([("1", "Fund")], "ein string, name string")
    named = G.with_granter_name(g, n, f)
    assert sorted(r.resolved_granter_name for r in named.collect()) == ["B", "Fund", "Non"]
    s = {(r.ein, r.taxyear): r for r in G.summaries(named, "grantee").collect()}
    assert s["9", 2020].granter_names == ["Fund"] and s[None, 2021].total_grant_amount == 0.0
    with pytest.raises(ValueError):
        G.for_eins(g, ["1"], "nobody")
    assert G.for_eins(g, [], "granter").count() == 0
    assert [r.taxyear for r in G.page_of(g, "granter", "1", 1, 5, G.GrantFilter(sort="grant_amount")).collect()] == [2021, 2020]
    groups = {r.group_key: r.label for r in G.grouped_by_entity(g, "grantee", n, f).collect()}
    assert groups == {"9": "Nine", "__name:Y": "Y"}
    assert {r.ein for r in G.grant_eligible(g, "granter", 2020, min_avg_grants=5, min_num_grants=2).collect()} == {"1"}
    assert G.totals(g, "granter", "none").first() == (0, 0, 0)


def test_canonical_tables(spark):
    stamps = "_source_version string, _ingest_run_id string"
    label = ["FORM 990, PART III, LINE 4A", "FORM 990-EZ, PART III", "990 PAGE 2 PART 3", "SCHEDULE A, PART III 990", "19904 PART 3", "990 PART 30", None]
    kept = spark.createDataFrame([(x, "t") for x in label], "sidfalrdesc string, supinfdetexp string")
    assert [r.sidfalrdesc for r in C.schedule_o_part_iii(kept).collect()] == label[:3]
    missions = spark.createDataFrame([("1", "2020", "b"), ("1", "2019", "old"), ("2", None, "n"), ("3", "2020", "")], "filerein string, taxyear string, mission string")
    programs = spark.createDataFrame([("1", "2020", "a", None, "b")], "filerein string, taxyear string, actividescri1 string, actividescri2 string, actividescri3 string")
    part = spark.createDataFrame([("1", "2020", "b")], "filerein string, taxyear string, supinfdetexp string")
    got = {r.ein: (r.unique_text_compact, r.n_snippets) for r in C.nonprofit_text(missions, programs, part).collect()}
    assert got == {"1": ("a\n\nb", 2), "2": ("n", 1)}
    off = spark.createDataFrame([("1", "Ann  LEE", "2020", "", None, "Boss", "0.30", "", "170059", None, None, "X", None, None, None, None, "", "v", "r")], "filerein string, namepeperson string, taxyear string, taxperend string, x string, titleitle string, avehouperwee string, avhopewereel string, repcomfroorg string, recofrrlorrg string, otherccompen string, officerffice string, inditrusdire string, instittruste string, keyempemploy string, highcompempl string, formerormer string, " + stamps)
    pf = spark.createDataFrame([("1", "ann lee", "2018", None, "T", "2", "3", None, "4", "v", "r")], "filerein string, odtkeiodtokepn string, taxyear string, taxperend string, odtkeiodtoketi string, odtkeiodtoke string, odtkeiodtokecom string, odtkeiodtokecoeb string, odtkeiodtokeeao string, " + stamps)
    (p,) = C.person_canonical(off, pf).collect()
    assert (p.first_taxyear, p.last_taxyear, p.n_filings, p.seen_on_990, p.seen_on_990pf, p.name) == (2018, 2020, 2, True, True, "ann lee")
    roles = {r.source_form: r for r in C.org_person_role(off, pf).collect()}
    assert roles["990"].is_officer and not roles["990"].is_former and roles["990-PF"].is_officer is None and roles["990-PF"].comp_other == 4
    assert {r.person_id for r in roles.values()} == {p.person_id}


def test_search(spark):
    assert [stem(w) for w in ("tutor", "tutored", "tutoring", "tutors", "generously", "skies", "agreed", "hopping", "relational")] == ["tutor"] * 4 + ["generous", "sky", "agre", "hop", "relat"]
    texts = [(1, "Tutoring for needs based students"), (2, "based on needs"), (3, "food security, hunger"), (4, "hunger emergency"), (5, None), (6, "the and of")]
    simple = spark.createDataFrame(texts, "id int, t string").select("id", T.tokens(F.col("t")).alias("doc"))
    ids = lambda df, q: sorted(r.id for r in df.where(T.matches(F.col("doc"), q)).collect())
    assert ids(simple, T.plain("based needs")) == [1, 2] and ids(simple, T.phrase("needs based")) == [1]
    web = T.websearch('"food security" OR hunger -emergency', "simple")
    assert ids(simple, web) == [3] and ids(simple, T.websearch('"food', "simple")) == [3] and ids(simple, None) == [] and T.websearch(" - \" ", "simple") is None
    english = T.english(simple, "id", "doc")
    assert ids(english, T.any_of(["tutors", ""], "stemmed")) == [1] and T.plain("the of", "english") is None
    for bad in (([], "stemmed"), ([" "], "stemmed"), (["x"], "nope")):
        with pytest.raises(ValueError):
            T.any_of(*bad)
    rank = {r.id: r.r for r in simple.select("id", T.rank(F.col("doc"), T.any_of(["hunger", "food"], "exact_words")).alias("r")).collect()}
    assert rank[4] == pytest.approx(0.1 / 1.64493406685 / 2) and rank[3] == pytest.approx(2 * rank[4]) and rank[5] == 0
    near = {r.id: r.r for r in simple.select("id", T.rank(F.col("doc"), T.plain("needs based")).alias("r")).collect()}
    assert near[1] > near[2] > near[3] == 1e-20
    q = T.plain("needs based")
    dense = {r.id: r.r for r in simple.select("id", T.cover_density(q)(F.col("doc")).alias("r")).collect()}
    assert dense[1] == pytest.approx(0.1) and dense[2] == pytest.approx(0.05) and dense[3] == 0
    index = T.inverted_index(simple, "id", "doc")
    assert sorted(r.id for r in T.search_index(index, "id", T.plain("needs based")).collect()) == [1, 2]
    for text in ('"food security" OR hunger -emergency', "hunger -emergency", '"needs based"', "nothing", ""):
        assert sorted(r.id for r in T.search_index(index, "id", T.websearch(text, "simple")).collect()) == ids(simple, T.websearch(text, "simple")), text
    only = T.websearch("-emergency", "simple")
    with pytest.raises(ValueError):
        T.search_index(index, "id", only)
    assert sorted(r.id for r in T.find(index, "id", only, simple).collect()) == [1, 2, 3, 5, 6]


def test_phrases_anywhere_in_a_document(spark):
    x = lambda n: "x " * n
    texts = [(1, "of x " * 300 + "of the"), (2, "the x of y " * 300 + x(9)), (3, x(17000) + "of the"), (4, x(16381) + "of " + x(600) + "the"), (5, x(16382) + "of the"), (6, x(17000) + "of x the"), (7, None), (8, "of the")]
    simple = spark.createDataFrame(texts, "id int, t string").select("id", T.tokens(F.col("t")).alias("doc"))
    index = T.inverted_index(simple, "id", "doc")
    for q, want in ((T.phrase("of the"), [1, 3, 5, 8]), (T.phrase("of x the"), [6]), (T.phrase("x x x"), [2, 3, 4, 5, 6])):
        assert sorted(r.id for r in simple.where(T.matches(F.col("doc"), q)).collect()) == want
        assert sorted(r.id for r in T.search_index(index, "id", q).collect()) == want
    web = T.websearch('"of the" OR y -the', "simple")
    assert sorted(r.id for r in simple.where(T.matches(F.col("doc"), web)).collect()) == [1, 3, 5, 8] == sorted(r.id for r in T.search_index(index, "id", web).collect())
    gone = T.phrase("the of the", "english")
    assert gone is None and simple.where(T.matches(F.col("doc"), T.phrase("the the"))).count() == 0


def test_a_dotted_capital_does_not_part_a_word(spark):
    docs = spark.createDataFrame([(1, "\u0130onth"), (2, "of the \u0130"), (3, "of\u0130 the"), (4, "\u0130ST"), (5, "onth reth"), (6, "onth"), (7, None)], "i int, text string").withColumn("doc", T.tokens(F.col("text")))
    found = lambda q: sorted(r.i for r in docs.where(T.matches(F.col("doc"), T.websearch(q, "simple"))).collect())
    assert found('"of the" OR onth -reth') == [2, 6] and found("\u0130st") == found("ist") == [4]


def test_null_aware_not_in_and_classes(spark):
    a, b = spark.createDataFrame([(1,), (None,), (3,)], "k int"), spark.createDataFrame([(1,)], "x int")
    assert [r.k for r in X.not_in(a, "k", b).collect()] == [3]
    assert X.not_in(a, "k", b.unionByName(spark.createDataFrame([(None,)], "x int"))).count() == 0 and X.not_in(a, "k", b.limit(0)).count() == 3
    assert sorted((str(r.k), r.form) for r in X.classify(a, "k", {"990": b, "990PF": b}).collect()) == [("1", "990PF"), ("3", "unknown"), ("None", "unknown")]


def test_quality_checks(spark):
    df = spark.createDataFrame([("1", "v", "u", "i", "r")] * 99 + [(None, "v", "u", "i", "r")], "k string, _source_version string, _source_url string, _ingested_at string, _ingest_run_id string")
    status = lambda *a, **b: {c.name: c.status for c in Q.validate(*a, raise_on_fail=False, **b)}
    assert set(status(df, ("k",)).values()) == {"pass"}
    assert status(df.withColumn("k", F.nullif("k", F.lit("1"))), ("k",))["required_columns"] == "fail"
    assert status(df, ("k", "gone"), ["k", "old"], 40) == {"row_count_positive": "pass", "lineage_columns": "pass", "required_columns": "fail", "schema_drift": "fail", "row_count_delta": "warn"}
    assert status(df, ("k",), [], 125)["schema_drift"] == "warn" and status(df, ("k",), None, 125)["row_count_delta"] == "pass" and status(df, ("k",), None, 126)["row_count_delta"] == "warn"
    with pytest.raises(Q.ValidationError):
        Q.validate(df.limit(0), ("k",))
    assert status(df.withColumn("_ingested_at", F.lit(None)), ("k",))["lineage_columns"] == "fail"


def test_csv_and_names(spark, tmp_path):
    assert R.column_names(["A Col", "A-Col", "a (c)", "A Col", "__x.."]) == ["a_col", "a_col_1", "a_c", "a_col_2", "x"]
    (tmp_path / "a.csv").write_bytes(b'A Col,b,c\n"x\ny",2,"q""q"\n1\n1,2,3,4\n,"",\xff\n')
    rows = [tuple(r) for r in R.read_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert rows == [("x\ny", "2", 'q"q'), ("1", None, None), ("1", "2", "3"), (None, None, "�")]
    (tmp_path / "e.csv").write_bytes(b"")
    with pytest.raises(ValueError):
        R.read_csv(spark, str(tmp_path / "e.csv"))
    (tmp_path / "p.csv").write_text("funder_ein|recip_ein|gm_name\n1-2|3-4|a\n12|34|b\n|5|c\n", encoding="utf-16")
    assert [tuple(r)[:2] for r in R.read_labelled_pairs(spark, str(tmp_path / "p.csv")).collect()] == [("12", "34")]
    source = R.get_source("irs_schedule_o")
    names = [(n, 1, 0) for n in ("2024_01_01_All_Years_ScheduleO.csv", "2025_01_01_All_Years_Schedule_O.csv", "2025_01_01_All_Years_ScheduleO.csv", "x.csv")]
    assert R.resolve_latest(source, "/d", names).url == "/d/2025_01_01_All_Years_Schedule_O.csv" and R.resolve_latest(source, "/d", []) is None
    with pytest.raises(KeyError, match="irs_schedule_o"):
        R.get_source("nope")


def publish(folder):
    files = {
        "990StandardFields": "filerein,taxyear,taxperend,filername1,filername2,dbanbnline11,dbanbnline22,incarenm,filerus1,filerus2,fileruscity,filerusstate,fileruszip,filerforctry,websitsiteit,formationorm,totrevcuryea,totacashcont,governgrants,donoadvifund\n000000001,2020,202012,Hope House,,,,,1 Main St,,New York,NY,10001,,,,100,50,,1\n000000001,2021,202112,Hope House Inc,,,,,1 Main St,,New York,NY,10001,,,,200,150,20,0\n",
        "990PFStandardFields": "filerein,taxyear,taxperend,filername1,filername2,filerus1,filerus2,fileruscity,filerusstate,fileruszip,filerforctry,filerphone\n000000009,2020,202012,Big Fund,,,,,,,,555\n",
        "990Part1Missions": "filerein,taxyear,mission\n000000001,2021,We tutor children\n000000077,2021,Tutoring only\n",
        "990Part3Programs": "filerein,taxyear,actividescri1,actividescri2,actividescri3\n000000001,2021,meals,,\n",
        "ScheduleO": "filerein,taxyear,sidfalrdesc,supinfdetexp\n000000001,2021,\"FORM 990, PART III\",more\n",
        "ScheduleIPart2Grants": "filerein,filername1,filername2,url,taxyear,taxperbegin,taxperend,rteinorecipi,rtrnbbnline11,rtrnbbnline22,retaadadliin1,retaadadliin2,rectabaddcit,rectabaddsta,rtazipcode,retaamofcagr,retapuofgrra\n000000001,Hope House,,u,2021,,,000000077,Rec,,,,,,,9,q\n",
        "990PFPart14Grants3A": "filerein,filername1,filername2,filesha256,url,taxyear,taxperbegin,taxperend,sigocpyrpnam,sigocpyrbnbn1,sigocpyrbnbn2,sigocpyrfaal1,sigocpyrfaal2,sigocpyrfaci,sigocpyrfapo,sigocpyrfapc,sigocpyamoun,sigocpypogoc,sigocpyrfsta,sigocpyrrela\n000000009,Big Fund,,sha,u,2021,,,,Hope House Inc,,1 Main Street,,New York,NY,10001,40,p,,\n",
    }
    for stem_, text in files.items():
        (folder / f"2025_01_01_All_Years_{stem_}.csv").write_text(text)


def test_refresh_build_and_client_end_to_end(spark, tmp_path):
    origin, home = tmp_path / "origin", str(tmp_path / "home")
    origin.mkdir()
    publish(origin)
    assert main([home, "refresh", "--from", str(origin)], spark) == 0
    catalog = Catalog(spark, home)
    assert catalog.runs().where("status = 'success'").count() == 7 and catalog.loaded().count() == 7
    assert main([home, "refresh", "--from", str(origin), "--source", "irs_990_missions"], spark) == 0 and catalog.runs().count() == 7
    assert main([home, "status", "--from", str(origin)], spark) == 2
    build = catalog.build(with_matching=True)
    builds = {r.build_kind: r for r in catalog.builds().collect()}
    assert {r.status for r in builds.values()} == {"success"} and builds["canonical"].build_id == build
    # The same inputs are not matched again; a trial is kept apart.
    assert set(builds) == {"canonical", "grant_matching"} and catalog.match() == builds["grant_matching"].build_id
    assert main([home, "match", "--limit", "0"], spark) == 0 and main([home, "match", "--force"], spark) == 0
    assert catalog.table("privategrants_w_recipients").count() == 1 and catalog.table("privategrants_w_recipients", "grant_matching_limit_0").count() == 0
    assert catalog.builds().count() == 4
    with pytest.raises(KeyError):
        catalog.table("person_canonical")
    with pytest.raises(RuntimeError, match="irs_990pf_grants"):
        Catalog(spark, home + "2").match()
    assert catalog.table("nonprofit_index_english").where("lexeme = 'tutor'").count() == 2
    client = Client(spark, catalog.table)
    hits = client.search_nonprofits(["tutors"], return_text=True).collect()
    assert [(h.ein, h.name) for h in hits] == [("000000001", "Hope House Inc"), ("000000077", None)] or [(h.ein, h.name) for h in hits] == [("000000077", None), ("000000001", "Hope House Inc")]
    assert [h.ein for h in client.search_nonprofits(["tutors"], min_avg_contributions=100, min_taxyear=2020).collect()] == ["000000001"]
    assert client.search_nonprofits(["tutors"], min_num_grants=1, min_taxyear=2021, limit=1).count() == 1
    with pytest.raises(ValueError):
        client.search_nonprofits(["x"], min_avg_grants=1)
    assert client.get_nonprofit("000000001").first().unique_text_compact == "We tutor children\n\nmeals\n\nmore"
    assert sorted(r.total_cash_contributions_no_gov for r in client.get_basic_fields(["000000001"]).collect()) == [50, 130]
    assert client.get_grants(["000000001"]).first().resolved_granter_name == "Big Fund" and client.get_grants([]).count() == 0
    assert client.get_grant_summaries(["000000001"], role="granter").first().grant_count == 1
    assert client.find_eins_with_min_avg_contributions(["000000001"], min_taxyear=2020, min_avg=100).count() == 1
    # A version that lost a column is refused, and what is published stays.
    (origin / "2025_02_01_All_Years_990Part1Missions.csv").write_text("filerein,taxyear\n1,2022\n")
    assert main([home, "refresh", "--from", str(origin), "--source", "irs_990_missions"], spark) == 1
    assert "mission" in catalog.table("mission_statements").columns
    assert main([home, "loaded"], spark) == 0


def test_arrivals_are_loaded_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "2025_01_01_x.csv").write_text('a,b\n1,"x\ny"\n')
    for n in (1, 2):
        load_arrived(arrivals(spark, str(tmp_path / "in"), ["a", "b"]), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        assert len(rows) == n and {r._source_version for r in rows} == {"2025_01_01"}
        (tmp_path / "in" / "2025_01_01_y.csv").write_text("a,b\n2,z\n")


def test_searches_without_sql_read_all_documents(spark, tmp_path):
    from grantlake.queries import QUERIES

    texts = [(1, "onth reth", "en"), (2, "Onth, “reth” café", "en"), (3, "ONTH élan reth", "fr"), (4, "onth reth", None), (5, "onthé réth", "de"), (6, None, "en")]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("search_stemmed", "search_cover_density"):
        assert sorted(r.doc_id for r in QUERIES[name](spark, str(tmp_path)).collect()) == [1, 2, 3, 4], name


def test_address_words_end_at_punctuation(spark):
    lit = F.lit
    cases = {"12 O'Hare Street": "12 OHARE ST", "P.O. Box 9": "PO BOX 9", "1234-B Road": "1234B RD", "North/East  Avenue.": "NE AVE", "«Élan» Drive": "ÉLAN DR", "": "", "...": ""}
    assert one(spark, *[S.clean_address(lit(a)) for a in cases]) == tuple(cases.values())
    assert one(spark, S.clean_address(lit(None).cast("string"), lit(" a "), terms={"A": "B"})) == ("B",)


def test_stems_of_the_queries_sql():
    import re

    from grantlake.queries import STEMS

    for root, pattern in STEMS.items():
        suffixes = re.search(r"\((.*)\)\?$", pattern)[1].split("|")
        assert all(stem(root + s) == stem(root) for s in ["", *suffixes])


def test_stems_lie_where_the_tokens_lie(spark):
    rows = [(1, "The tutors of Tutoring"), (2, None), (3, "the of"), (4, "x " * 3000)]
    docs = spark.createDataFrame(rows, "id int, t string").repartition(2).select("id", T.tokens(F.col("t")).alias("doc"))
    out = {r.id: [(t.lexeme, t.pos) for t in r.doc] for r in T.english(docs, "id", "doc").collect()}
    assert out[1] == [("tutor", 2), ("tutor", 4)] and out[2] == out[3] == [] and len(out[4]) == 3000
    assert "Exchange" not in T.english(spark.range(3).select("id", T.tokens(F.lit("a b")).alias("doc")), "id", "doc")._jdf.queryExecution().optimizedPlan().toString()


def test_pointers_never_vanish(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    assert catalog._current("builds/canonical") is None
    for target in ("a", "b", "c"):
        catalog._publish("builds/canonical", target)
        assert catalog._current("builds/canonical") == target
    assert catalog._pointers("builds/canonical") == [1, 2, 3]


def test_named_summaries_equal_summaries_of_named_grants(spark):
    rows = [("1", "A", "s", "9", 2020, 10), ("1", "A", None, "9", 2020, None), ("1", "A2", None, "9", 2020, 3), ("2", "B", None, "9", 2020, 4), (None, "C", "s", None, None, None)]
    g = spark.createDataFrame(rows, "granter_ein string, granter_name string, filesha256 string, grantee_ein string, taxyear int, grant_amount long")
    n, f = spark.createDataFrame([("1", "Non")], "ein string, name string"), spark.createDataFrame([("1", "Fund")], "ein string, name string")
    for role in ("grantee", "granter"):
        assert sorted(map(str, G.summaries_named(g, n, f, role).collect())) == sorted(map(str, G.summaries(G.with_granter_name(g, n, f), role).collect()))


def test_groups_as_pages_and_their_grants(spark):
    rows = [("1", 2020, 10, "9", "X"), ("1", 2021, 5, None, "Y"), ("1", None, None, None, "Y"), ("1", 2021, 7, None, None)]
    g = spark.createDataFrame(rows, "granter_ein string, taxyear int, grant_amount long, grantee_ein string, grantee_organization_name1 string").withColumns({c: F.lit(None).cast("string") for c in ("grantee_organization_name2", "grantee_person_name", "grant_purpose")})
    assert [r.group_key for r in G.group_page(G.grouped_by_year(g), True, 1, 2).collect()] == [None, "2021"]
    none = spark.createDataFrame([], "ein string, name string")
    groups = G.grouped_by_entity(g, "grantee", none, none)
    assert [r.label for r in G.group_page(groups, False, 1, 5).collect()] == ["X", "Unknown", "Y"]
    assert [r.taxyear for r in G.expand_group(g, "granter", "1", "__name:Y", False).collect()] == [None, 2021] and G.expand_group(g, "granter", "1", None, True).count() == 1


def test_fuzzy_bounds_lose_no_pair(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(0, 9)))
    left = spark.createDataFrame([(i, 1, word(), word()) for i in range(60)] + [(99, 1, None, None)], "i int, block int, name_l string, addr_l string")
    right = spark.createDataFrame([(i, 1, word(), word()) for i in range(60)] + [(99, 1, None, "")], "j int, block int, name_r string, addr_r string")
    for rules in (K.STRICT, K.LOOSE):
        pairs = left.join(right, "block").withColumn("addr_score", K.edit_similarity(F.col("addr_l"), F.col("addr_r"))).withColumn("name_score", K.jaro_winkler_udf("name_l", "name_r"))
        want = {(r.i, r.j) for r in pairs.where(rules.condition()).collect()}
        assert want == {(r.i, r.j) for r in K.candidates(left, right, "block", "name", "addr", rules).collect()} and want
    share = K.matched_share(spark.createDataFrame([("a",), ("a",), (None,)], "e string"), "e", spark.createDataFrame([("a",), ("b",)], "k string"), "k").first()
    assert (share.n_matched, share.n_organisations, share.share) == (1, 2, 0.5)


def test_similarity_in_columns_equals_that_of_a_pair(spark):
    rng = random.Random(3)
    word = lambda most: "".join(rng.choice("abcé\U0001f600 ") for _ in range(rng.randrange(0, most)))
    pairs = [(word(12), word(12)) for _ in range(2000)] + [(word(90), word(90)) for _ in range(60)] + [("a" * 70, "a" * 70), ("", ""), (None, "a"), ("martha", "marhta")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", K.jaro_winkler_udf("a", "b").alias("s")).collect()
    assert all(r.s == K.jaro_winkler(r.a, r.b) for r in rows) and K.jaro_winkler_of(*K._coded([]), *K._coded([])).size == 0


def test_copies_are_compared_once(spark):
    n, name = 40_000, F.concat(F.lit("hope house "), F.col("id") % 3)
    side = lambda key, s: spark.range(n).select(F.col("id").alias(key), F.lit(1).alias("block"), name.alias(f"name_{s}"), F.lit("1 main st").alias(f"addr_{s}"))
    began = time.perf_counter()
    best = K.match(side("recipient", "l"), side("ein", "r"), "block", "name", "addr", "recipient", "ein")
    assert best.groupBy(F.col("recipient") % 3 == F.col("ein"), "name_score").count().collect() == [(True, 1.0, n)]
    assert time.perf_counter() - began < 60  # 1.6 billion pairs of rows, nine of classes
    few = [side("i", "l").where("id < 30"), side("j", "r").where("id < 30")]
    pairs = K.candidates(*few, "block", "name", "addr", K.Rules((0.99, 0.5), (0.999, 0.85), (0.999, 0.9)))
    assert set(pairs.columns) == {"block", "i", "name_l", "addr_l", "j", "name_r", "addr_r", "addr_score", "name_score"}
    assert sorted((r.i, r.j) for r in pairs.collect()) == [(i, j) for i in range(30) for j in range(30) if i % 3 == j % 3]


def test_edit_distances_in_columns_equal_those_of_a_pair():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(4)
    word = lambda most: "".join(rng.choice("abcé\U0001f600 \0") for _ in range(rng.randrange(most)))
    left, right = ([word(m) for m in (10, 30, 67, 300) for _ in range(9)] + ["", "a" * 64, "a" * 63 + "b"] for _ in "lr")
    texts = Texts(pa.chunked_array([left]), pa.chunked_array([right]))
    pairs = [(i, j) for i in range(len(left)) for j in range(len(right))]
    a, b = texts.left[[i for i, _ in pairs]], texts.right[[j for _, j in pairs]]
    want = [1 - plain(left[i], right[j]) / max(len(left[i]), len(right[j])) if left[i] or right[j] else 0.0 for i, j in pairs]
    assert texts.addresses(a, b, 0.0).tolist() == want
    assert texts.addresses(a, b, 0.6).tolist() == [w if 1 - abs(len(left[i]) - len(right[j])) / max(len(left[i]), len(right[j]), 1) >= 0.6 else 0.0 for w, (i, j) in zip(want, pairs)]
    assert texts.names(a, b).tolist() == [K.jaro_winkler(left[i], right[j]) for i, j in pairs]


def test_large_blocks_are_compared_in_tiles(spark, monkeypatch):
    text = lambda seed: F.left(F.md5(F.concat(F.lit(seed), F.col("id"))), F.lit(24))
    side = lambda key, s: spark.range(5000).select(F.col("id").alias(key), F.lit(1).alias("block"), text("n").alias(f"name_{s}"), text("a").alias(f"addr_{s}"))
    began = time.perf_counter()
    best = K.match(side("recipient", "l"), side("ein", "r"), "block", "name", "addr", "recipient", "ein")
    assert best.where("recipient = ein and name_score = 1 and addr_score = 1").count() == 5000
    assert time.perf_counter() - began < 60  # 25 million pairs of different texts in one block
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(9)))
    rows = lambda: [(i, rng.choice(["x", "x", "y", None]), word(), word()) for i in range(80)]
    left, right = spark.createDataFrame(rows(), "i int, block string, name_l string, addr_l string"), spark.createDataFrame(rows(), "j int, block string, name_r string, addr_r string")
    monkeypatch.setattr(K, "SIDE", 7)
    pairs = left.join(right, "block").withColumn("addr_score", K.edit_similarity(F.col("addr_l"), F.col("addr_r"))).withColumn("name_score", K.jaro_winkler_udf("name_l", "name_r"))
    columns = ["i", "j", "addr_score", "name_score"]
    want = sorted(map(tuple, pairs.where(K.LOOSE.condition()).select(columns).collect()))
    assert want == sorted(map(tuple, K.candidates(left, right, "block", "name", "addr", K.LOOSE).select(columns).collect())) and want


def test_equal_organisations_are_cleaned_once(spark):
    private, basic = grant_fixture(spark)
    twins = basic.unionByName(basic.withColumn("filerein", F.concat("filerein", F.lit("7"))))
    (_, every), (_, firsts) = _sides(private, twins), _sides(private, twins, firsts=True)
    assert (every.count(), firsts.count()) == (6, 2) and not firsts.where("filerein_key like '%7'").count()
    plan = firsts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract_all") < plan.index("min(filerein_key")
    assert sorted(match_recipients(private, twins).collect()) == sorted(match_recipients(private, basic).collect())


def test_pairs_of_rows_unfold_from_arrays(spark, monkeypatch):
    monkeypatch.setattr(K, "MEMBERS", 3)
    left = spark.createDataFrame([(i, i % 2, None if i % 3 else "", "1 main st") for i in range(20)] + [(i, 1, "hope", "1 main st") for i in (7, 7, 8)], "i int, block int, name_l string, addr_l string")
    right = spark.createDataFrame([(i, 1, "hopes", "1 main st", "x") for i in range(11)], "j int, block int, name_r string, addr_r string, more string")
    pairs = K.candidates(left, right, "block", "name", "addr", K.Rules((0.9, 0.5), (0.99, 0.85), (0.0, 0.95)), places=2)
    assert pairs.columns == ["i", "block", "name_l", "addr_l", "j", "name_r", "addr_r", "more", "addr_score", "name_score"]
    want = [(i, 1, n, j, "x", 1.0, 0.96 if n else 0.0) for i, b, n, _ in left.collect() if b == 1 for j in range(11)]
    key = lambda r: (r[0], r[2] or "", r[3])
    assert sorted(map(tuple, pairs.select("i", "block", "name_l", "j", "more", "addr_score", "name_score").collect()), key=key) == sorted(want, key=key)
    # Scores are rounded, and classes joined, before pairs of rows are made.
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner") < plan.index("round(name_score")


def test_block_pairs_equal_a_join(spark):
    left = spark.createDataFrame([(i, "xyz"[i % 3] if i % 5 else None) for i in range(50)] + [(1, "x"), (7, "alone")], "recipient int, block string")
    right = spark.createDataFrame([(i, "xy"[i % 2] if i % 7 else None) for i in range(300)] + [(5, "y")], "ein long, block string")
    pairs, plain = K.block_pairs(left, right, "block", "ein"), left.join(right, "block").select("recipient", "block", "ein")
    assert pairs.columns == plain.columns and sorted(map(tuple, pairs.collect())) == sorted(map(tuple, plain.collect()))
    # A row of the join is as many pairs as an array holds.
    joined = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert joined.index("Generate explode") < joined.index("Join Inner")


def test_equal_totals_go_to_the_better_name(spark):
    name, address, other, further = 0.7, 0.5, 0.68, 0.54
    assert 2 * other + further > 2 * name + address  # in floating point only
    pairs = spark.createDataFrame([(1, "a", other, further), (1, "b", name, address)], "r int, ein string, name_score double, addr_score double")
    assert [r.ein for r in L.best_match(pairs, "r").collect()] == ["b"]


def test_join_back_repeats_no_row(spark):
    rows, mapping = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"), spark.createDataFrame([("a", "y"), ("a", "x"), (None, "z")], "k string, m string")
    assert [tuple(r) for r in K.join_back(rows, mapping, ["k"]).collect()] == [("a", 1, "x")]


FORM = "filerein taxyear url filername1 filername2 filerus1 filerus2 fileruscity filerusstate fileruszip donoadvifund totrevcuryea totacashcont federacampai memberduesue fundraevents relateorgani governgrants alloothecont noncascontri"
FORM_PF = "filerein taxyear url filername1 filername2 filerus1 filerus2 fileruscity filerusstate fileruszip areterexpnss anreextoreex arecrrexpnss " + " ".join(c for p in X.CHARITABLE + X.INVESTMENTS for c in p) + " spriaopritot suprreintoot"
IDENTITY = "ein name name_secondary dba_1 dba_2 care_of addr_line_1 addr_line_2 city state zip addr_country website formation_year latest_taxyear source_run_id source_version _built_at"


def rows_of(spark, names, rows):
    return frame(spark, names, [tuple(r.get(n) for n in names.split()) for r in rows])


def explorer_tables(spark, empty=False):
    docs = [] if empty else [("1", "we tutor children"), ("3", "tutoring and tutors")]
    text = T.english(spark.createDataFrame(docs, "ein string, t string").select("ein", T.tokens(F.col("t")).alias("tokens_english")), "ein", "tokens_english")
    made = {
        "basic_fields": rows_of(spark, FORM, [] if empty else [
            {"filerein": "1", "taxyear": "2020", "filername1": "Old", "totrevcuryea": "10", "totacashcont": "4.9", "donoadvifund": "true"}, {"filerein": "1", "taxyear": "2021", "totrevcuryea": "", "donoadvifund": "0"},
            {"filerein": "123456789", "taxyear": "2019", "filername1": "Nine", "totrevcuryea": "5"}, {"filerein": None, "taxyear": "2019"}]),
        "basic_fields_pf": rows_of(spark, FORM_PF, [] if empty else [
            {"filerein": "1", "taxyear": "2020", "areterexpnss": "1"}, {"filerein": "9", "taxyear": "2020", "filername1": "Fund", "areterexpnss": "7", "anreextoreex": "8", "sudichacdees1": " a ", "sudichacexxp2": "0", "sudichacexxp3": "5", "suprreindees1": "loan", "suprreinammo1": "2", "spriaopritot": "3"},
            {"filerein": "9", "taxyear": "2021", "areterexpnss": "-2"}]),
        "nonprofit_canonical": rows_of(spark, IDENTITY, [] if empty else [{"ein": "1", "name": "Hope tutors", "latest_taxyear": "2021"}, {"ein": "123456789", "name": "Nine", "dba_2": "A Hope", "latest_taxyear": ""}, {"ein": "3", "name": "EZ", "latest_taxyear": "2018"}]),
        "funder_canonical": rows_of(spark, IDENTITY.replace("dba_1 dba_2 care_of ", "").replace("website formation_year ", ""), [] if empty else [{"ein": "9", "name": "Hope Fund", "latest_taxyear": "2021"}]),
        "mission_statements": rows_of(spark, "filerein taxyear mission", [] if empty else [{"filerein": "1", "taxyear": "2020", "mission": "m0"}, {"filerein": "1", "taxyear": "", "mission": "m?"}, {"filerein": "1", "taxyear": "2021", "mission": "m1"}, {"filerein": "1", "taxyear": "2021", "mission": ""}]),
        "programs": rows_of(spark, "filerein taxyear actividescri1 actividescri2 actividescri3", [] if empty else [{"filerein": "1", "taxyear": "2021", "actividescri1": "p1", "actividescri2": " ", "actividescri3": "p3"}]),
        "schedule_o_part_iii": rows_of(spark, "filerein taxyear supinfdetexp", []),
        "nonprofit_text": text,
        "nonprofit_index_english": T.inverted_index(text, "ein", "tokens_english"),
    }
    return made.__getitem__


def test_composed_search(spark):
    t = explorer_tables(spark)
    found = lambda *a, **k: [(r.ein, r.org_type, r.first_year, r.last_year, r.total) for r in X.run_search(t, *a, **k).collect()]
    assert found("hope") == [("9", "foundation", 2020, 2021, 3), ("1", "nonprofit", 2020, 2021, 3), ("123456789", "nonprofit", 2019, None, 3)]
    assert found("hope", page=2, limit=2) == [("123456789", "nonprofit", 2019, None, 3)] and found("hope", daf_only=True) == [("1", "nonprofit", 2020, 2021, 1)]
    assert [r[0] for r in found("12-3456789", mode="narrative")] == ["123456789"]
    # Both tiers find the first, by name; the other has more covers but no first year of its own.
    assert found("tutors") == [("1", "nonprofit", 2020, 2021, 2), ("3", "nonprofit", 2018, 2018, 2)] and [r[0] for r in found("tutors", mode="narrative")] == ["3", "1"]
    assert [r[0] for r in found("-children", mode="narrative")] == ["3"]
    assert found("  ") == [] and found("hope", "foundation", daf_only=True) == [] and found("hope", "foundation", mode="narrative") == [] and len(found("hope", "nonsense", "x", 0, "nope")) == 3
    assert X.run_search(explorer_tables(spark, empty=True), "hope").count() == 0


def test_profile_of_both_forms(spark):
    p = {r.ein: r for r in X.org_profile(explorer_tables(spark)).collect() if r.ein}
    one_, nine = p["1"], p["9"]
    assert set(p) == {"1", "9", "123456789"} and (one_.org_type, one_.name, one_.first_year, one_.last_year, one_.revenue, one_.has_daf) == ("nonprofit", "Hope tutors", 2020, 2021, 10, True)
    assert [tuple(x) for x in one_.revenue_by_year] == [(2020, 10), (2021, None)] and one_.revenue_details[0].total_contributions == 4
    assert [x.text for x in one_.missions] == ["m?", "m1", "m0"] and [x.text for x in one_.programs] == ["p1", "p3"] and one_.schedule_o is None and one_.activities is None
    assert [tuple(x) for x in one_.daf_by_year] == [(2020, True), (2021, False)]
    assert (nine.org_type, nine.name, nine.dba_1, nine.revenue, nine.missions, nine.has_daf) == ("foundation", "Hope Fund", None, 5, None, False)
    [a] = nine.activities
    assert [tuple(s) for s in a.charitable] == [("a", None), ("", 5)] and (a.direct, a.invested, a.total) == (5, 5, None)
    assert nine.revenue_details[0].total_revenue == 8 and nine.revenue_details[0].government_grants is None
    assert X.org_profile(explorer_tables(spark), "9").count() == 1 and X.org_profile(explorer_tables(spark, empty=True)).count() == 0
    bars = X.with_bars(spark.createDataFrame([("1", 2020, 100), ("1", 2021, 1), ("1", 2022, None), ("2", 2020, -3)], "ein string, taxyear int, revenue long"))
    assert [r.height for r in bars.orderBy("ein", "taxyear").collect()] == [56.0, 4.0, 4.0, 4.0]
