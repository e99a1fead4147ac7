"""Sources and pipelines on small made-up files; incremental loads; entity resolution."""

from pyspark.sql import functions as F

from ledgerloom.functions.countries import country_code
from ledgerloom.operators import entity as E
from ledgerloom.operators import ordered as W
from ledgerloom.operators import tables as T
from ledgerloom.operators.graph import cooccurrence, min_labels
from ledgerloom.operators.metadata import Dataset, described_by_words, with_comments
from ledgerloom.operators.joins import join_disjoint, override, update_join
from ledgerloom.plans import accounts, census, environment, patents, surveys
from ledgerloom.sources import markup, texts
from ledgerloom.streaming.ledger import load_new_files, loaded, set_aside
from tests.conftest import rows


def files(spark, *pairs):
    return spark.createDataFrame(list(pairs), "file string, text string")


def test_update_join_keeps_rows_and_overwrites_with_null(spark):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    s = spark.createDataFrame([(1, None), (None, "z"), (3, "q")], "key int, w string")
    assert rows(update_join(t, s, {"k": "key"}, {"v": "w", "n": "w"})) == sorted([(1, None, None), (1, None, None), (2, "b", None), (None, "c", None)], key=str)
    assert rows(override(t, s, "k", "v") if False else override(t, s.select(F.col("key").alias("k"), F.col("w").alias("v")), "k", "v"), "k", "v") == rows(t)


def test_hierarchy_and_fill(spark):
    data = [(0, 0, "a"), (1, 2, "b"), (2, 4, "c"), (3, 2, "d"), (4, 0, "e"), (5, 4, "f")]
    h = W.hierarchy(spark.createDataFrame(data, "pos int, ind int, t string"), "t", "ind", "pos", 3)
    assert [(r["level"], r["path"]) for r in h.orderBy("pos").collect()] == [(0, ["a"]), (1, ["a", "b"]), (2, ["a", "b", "c"]), (1, ["a", "d"]), (0, ["e"]), (1, ["e", "f"])]
    f = W.fill_down(spark.createDataFrame([(0, ""), (1, "x"), (2, ""), (3, None), (4, "y")], "pos int, v string"), "v", "pos")
    assert rows(f) == [(1, "x"), (2, "x"), (3, "x"), (4, "y")]
    b = W.without_blank_edges(spark.createDataFrame([(0, " "), (1, "x"), (2, ""), (3, "y"), (4, "")], "pos int, v string"), "v", "pos")
    assert [r[0] for r in b.orderBy("pos").collect()] == [1, 2, 3]


def test_header_paths(spark):
    data = [("1", 0, " ", "Subj."), ("1", 1, " ", "Table"), ("1", 2, "1", "Total:"), ("1", 3, "2", "Male"), ("1", 4, "2.5", "remark"), ("1", 5, "3", "Female")]
    h = W.header_paths(spark.createDataFrame(data, "seq string, pos int, line string, title string"), "title", "line", "pos", "seq")
    assert rows(h) == [("1", 1, "Subj|Table||Total"), ("1", 2, "Subj|Table|Total|Male"), ("1", 3, "Subj|Table|Total|Female")]


def test_types_and_names(spark):
    df = spark.createDataFrame([("1", "1.5", "x", ""), ("-2", "3", "1", " ")], "a string, b string, c string, d string")
    assert rows(T.infer_types(df)) == [("a", "INTEGER"), ("b", "REAL"), ("c", "VARCHAR"), ("d", "VARCHAR")]
    assert T.header_names(["A b", "a-b", ""]) == ["A_b", "a_b2", "col"]
    assert T.info_and_data(["x", "1999", "y"]) == {"Info": ["x"], "Data": ["1999", "y"]}


def test_join_disjoint(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, x int"), spark.createDataFrame([(1, 3), (2, 4)], "k int, y int")
    assert rows(join_disjoint([a, b], ["k"])) == [(1, 2, 3), (2, None, 4)]


def test_graphs(spark):
    e = spark.createDataFrame([("b", "c"), ("c", "a"), ("x", "y"), (None, "q")], "a string, b string")
    assert rows(min_labels(e), "id", "label") == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")]
    v, g = cooccurrence(spark.createDataFrame([("p", 1, 5), ("q", 1, 5), ("q", 1, 5), ("q", 2, 6), (None, 1, 5)], "n string, e int, y int"), "n", "e", "y")
    assert rows(v) == [("p", 1), ("q", 2)] and rows(g) == [("p", "q", 1, 5)]


def test_disambiguation_is_deterministic(spark):
    data = [("Acme Tool Company", 9), ("ACME TOOL COMPANY", 2), ("Acme  Tool Compny", 1), ("Zeta Paper Limited", 3), ("", 5), (None, 1)]
    a = rows(E.disambiguate(spark.createDataFrame(data, "name string, cnt int")), "name", "cluster")
    b = rows(E.disambiguate(spark.createDataFrame(data[::-1], "name string, cnt int")), "name", "cluster")
    assert a == b and dict(a)["Acme Tool Company"] == "ACME TOOL COMPANY" and len(a) == 4
    c = E.disambiguate(spark.createDataFrame(data, "name string, cnt int"))
    assert ("ACME TOOL COMPANY", "Acme Tool Company") in rows(E.cluster_names(c), "cluster", "title")


def test_disambiguation_compares_all_names_of_a_block(spark):
    # all in one block of endings; AAAA... is smallest and like none of the others
    tail = " INTERNATIONAL HOLDINGS COMPANY"
    names = ["AAAAQXZ" + tail, "SHIEGLEND" + tail, "SHIEGLEMD" + tail]
    got = dict(rows(E.disambiguate(spark.createDataFrame([(n, 1) for n in names], "name string, cnt int")), "name", "cluster"))
    assert got == {names[0]: names[0], names[1]: names[2], names[2]: names[2]}
    some = spark.createDataFrame([(i, "k" if i < 9 else "z") for i in range(10)], "i int, k string")
    assert rows(E.block_pairs(some, "k", "i", 2), "l.i", "r.i") == sorted([(i, j) for i in range(9) for j in range(i + 1, 9)], key=str)
    words = spark.createDataFrame([("CORPORATION", 90), ("CORPORATIO", 1), ("CORPS", 1)], "word string, count long")
    assert rows(E.typo_words(words, 50.0)) == [("CORPORATIO", 90)]


def test_cascade(spark):
    places = spark.createDataFrame([(1, "BERLIN", "X"), (2, "BER LIN", "X"), (3, "BERLIM", "X"), (4, "PARIS", "X"), (5, "BERLIN", "Y")], "id int, city string, country string")
    ref = spark.createDataFrame([(10, "BERLIN", "X"), (11, "ROMA", "X")], "ref_id int, r_city string, country string")
    got = E.cascade(places, ref, "id", E.place_stages(-1, False), ["country"])
    assert rows(got, "id", "ref_id", "stage") == [(1, 10, "domestic exact -1"), (2, 10, "domestic joined -1"), (3, 10, "domestic first letters -1")]


def test_geocode_tries_all_parts_countries_corrections_and_zip(spark):
    ref = spark.createDataFrame([(1, "ADAMTON", "OH", "US", "11111"), (2, "ADAMTON", "WI", "US", "22222"), (3, "BERNVILLE", None, "DE", None)], "ref_id int, r_city string, state string, country string, zipcode string")
    places = [
        (1, "ADAMTON", "WI", "US", None, None),
        (2, "X,Y,ADAMTOM", "OH", "US", None, None),
        (3, "X,Y,BERNVILL", None, "DE", None, None),
        (4, "BERNVILLE", None, None, None, None),
        (5, "QQ", None, "DE", None, "BERN VILLE"),
        (6, "QQ", None, "US", "22222-1234", None),
        (7, "QQ", None, "DE", "22222", None),
        (8, "BERNVILLE", None, "FR", None, None),
    ]
    df = spark.createDataFrame(places, "id int, city string, state string, country string, zipcode string, ncity string").withColumns({"nstate": F.lit(None).cast("string"), "ncountry": F.lit(None).cast("string")})
    assert rows(E.geocode(df, ref), "id", "ref_id", "stage") == [
        (1, 2, "domestic exact -1"),
        (2, 1, "domestic first letters 2"),
        (3, 3, "foreign first letters 2"),
        (4, 3, "anywhere exact -1"),
        (5, 3, "foreign joined corrected"),
        (6, 2, "domestic zip"),
    ]
    typed = ["usa", "U.S.A.", "United States", "España", "KRX", "Rep. of Korea", "nj", "CA", " ", None, "Brazil"]
    got = spark.createDataFrame(list(enumerate(typed)), "i int, c string").select("i", country_code(F.col("c"), F.lit("X")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in got] == ["US", "US", "US", "ES", "KR", "KR", "US", "CA", None, None, "BRAZIL"]


def test_head_metadata_keeps_all_lines(spark):
    head = spark.createDataFrame([("f", i, f"line {i}", "head") for i in range(1500)] + [("g", 0, "alone", "head")], "file string, pos int, line string, section string")
    got = {r["file"]: r["notes"] for r in texts.head_metadata(head).collect()}
    assert got == {"f": "\n".join(f"line {i}" for i in range(1, 1500)), "g": ""}


def test_surveys(spark):
    series = spark.createDataFrame([("S1 ", "01", "x"), ("S2", "99", "y")], "series_id string, area_code string, kind string")
    data = spark.createDataFrame([("S1", "2000", "M01", " 5 "), ("S1", "2000", "M13", "6"), ("S1", "2001", "Q1", " "), ("S9", "2000", "A1", "1")], "series_id string, year string, period string, value string")
    area = spark.createDataFrame([("01 ", "Here")], "area_code string, area_name string")
    got = surveys.survey_records(series, data, {"area": area}).orderBy("series_id").collect()
    assert [(r["series_id"], r["area_name"], r["values"]) for r in got] == [("S1", "Here", {"2000XX01": "5", "2000XXXX": "6"}), ("S2", None, {})]
    assert surveys.space_code("state_code") == "f.s" and surveys.space_code("msa_name") == "m" and surveys.space_code("item") is None
    k = spark.createDataFrame([("AB", "wages, prices,")], "Code string, Keywords string")
    assert rows(surveys.keywords(k, "ab")) == [(0, "wages"), (1, "prices")]


ACCOUNT = '"Table 1. Income"\n[Millions]\n"Last Revised March 1, 2010"\n\nLine,,1929,1947-I\n1,"Total",10,---\n2,"  Wages\\1\\","1,000",2\n3,  Other,,4\n4,Gifts,1,1\n5,  Other,7,8\nNote. Something.\n'


def test_accounts(spark):
    long, meta = accounts.account_tables(files(spark, ("t1.csv", ACCOUNT)))
    got = {(r["line"], r["time"]): (r["label"], r["path"], r["value"]) for r in long.collect()}
    assert got["1", "1929XXX"] == ("Total", ["Total"], 10.0) and got["1", "19471XX"][2] is None
    assert got["2", "1929XXX"] == ("Wages", ["Total", "Wages"], 1000.0)
    assert got["5", "19471XX"] == ("Other - Gifts", ["Gifts", "Other"], 8.0) and len(got) == 10
    assert rows(meta, "title", "units", "revised") == [("Table 1. Income", "Millions", "March 1, 2010")]
    p = spark.range(1).select(accounts.place_of(F.lit("01003"), F.lit("Baldwin, AL"), "county").alias("p")).first()["p"]
    assert p["names"] == {"c": "Baldwin", "s": "AL"} and p["f"] == {"s": "01", "c": "003"}
    cross = accounts.crosstab(files(spark, ("x", "Head\n\nName,A - 2001,A - 2002\nAll,1,2\n  Sub,3,(D)\n\nfoot")), "^Name,", 3)
    assert rows(cross, "path", "group", "year", "value") == [(["All", "Sub"], "A", "2001", 3.0), (["All", "Sub"], "A", "2002", None), (["All"], "A", "2001", 1.0), (["All"], "A", "2002", 2.0)]


def test_census(spark):
    line = [" "] * 420
    for k, v in {"LOGRECNO": "0000001", "s": "01", "c": "003", "C": "1"}.items():
        a, _ = census.GEOGRAPHY[k]
        line[a - 1 : a - 1 + len(v)] = v
    geo = census.geography(spark.createDataFrame([("".join(line),)], "line string"))
    assert rows(geo) == [("0000001", {"C": "1", "s": "01", "c": "003"})]
    est = census.cells(spark.createDataFrame([("2009,x,y,0001,0000001,z,5,6",), ("short",)], "line string"), "estimate", 10)
    mar = census.cells(spark.createDataFrame([("2009,x,y,0001,0000001,z,1,2",)], "line string"), "margin", 10)
    head = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b")], "seq string, cell int, path string")
    assert rows(census.survey_cells(est, mar, head, geo), "title", "estimate", "margin") == [("a", "5", "1"), ("b", "6", "2")]


def test_environment(spark):
    html = '<table><tr bgcolor="#F5F5F5"><td>1</td><td><a href="u">Spring</a></td><td>Ohio 12</td><td>Lake</td></tr><tr><td>no</td></tr></table><b>Owner:</b> City<br><b>Fluoride concentration:</b> 0.70 mg/L'
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert rows(environment.water_systems(pages)) == [("u", "Spring", "Ohio", "12", "Lake")]
    d = {r["page_id"]: r for r in environment.water_details(pages, "page_id").collect()}
    assert d[1]["details"]["Owner"] == "City" and d[1]["concentration"] == 0.7 and d[2]["concentration"] == 0.0
    assert [tuple(x) for x in pages.select(markup.html_links(F.col("html")).alias("l")).first()["l"]] == [("u", "Spring")]
    code = spark.createDataFrame([("12", "9"), (" ", "9")], "a string, b string").select(environment.industry_code(F.col("a"), F.col("b")).alias("c"))
    assert [tuple(r["c"]) for r in code.collect()] == [("SIC", "12"), ("NAICS", "9")]


GRANT_XML = """<?xml version="1.0"?>
<us-patent-grant><us-bibliographic-data-grant>
<publication-reference><document-id><country>US</country><doc-number>07000001</doc-number><kind>B2</kind><date>20060214</date></document-id></publication-reference>
<application-reference appl-type="utility"><document-id><doc-number>11/1</doc-number><date>20030101</date></document-id></application-reference>
<classification-national><main-classification>123 45</main-classification><further-classification>D11544</further-classification></classification-national>
<invention-title>Thing</invention-title><number-of-claims>3</number-of-claims>
<references-cited><citation><patcit><document-id><country>US</country><doc-number>D105</doc-number><kind>S</kind><name>Doe</name><date>19900101</date></document-id></patcit><category>cited by examiner</category></citation><citation><othercit>A paper</othercit></citation></references-cited>
<us-related-documents><division><relation><child-doc><document-id><country>US</country><doc-number>1</doc-number></document-id></child-doc><parent-doc><document-id><country>US</country><doc-number>2</doc-number></document-id><parent-status>GRANTED</parent-status></parent-doc></relation></division></us-related-documents>
<parties><applicants><applicant><addressbook><last-name>Roe</last-name><first-name>Jo</first-name><address><city>Here</city><country>US</country></address></addressbook><nationality><country>omitted</country></nationality></applicant></applicants></parties>
<assignees><assignee><addressbook><orgname>Acme</orgname><role>02</role><address><city>There</city></address></addressbook></assignee><assignee><addressbook><last-name>Roe</last-name><first-name>Jo</first-name></addressbook></assignee></assignees>
</us-bibliographic-data-grant><abstract><p>Short.</p></abstract></us-patent-grant>"""


def test_patents(spark):
    broken = "<us-patent-grant><broken></us-patent-grant>"
    docs = markup.xml_documents(files(spark, ("a.xml", GRANT_XML + "\n" + broken)))
    assert docs.count() == 2
    g = markup.grants(docs)
    good, bad = set_aside(g)
    assert good.count() == bad.count() == 1
    t = patents.patent_tables(g)
    assert rows(t["patent"], "patent", "claims", "gyear", "pattype") == [("07000001", 3, 2006, "U")]
    assert rows(t["assignee"], "assignee", "asgtype", "asgseq") == [("Acme", 2, 0), ("Roe, Jo", 1, 1)]
    assert rows(t["citation"], "citation", "citseq") == [("D0000105", 0)] and rows(t["sciref"], "descrip", "citseq") == [("A paper", 0)]
    assert rows(t["class"], "prim", "class", "subclass") == [(0, "D11", "544"), (1, "123", "45")]
    assert rows(t["usreldoc"], "doctype", "side", "relpatent", "orderseq") == [("division", -1, "1", 0), ("division", 1, "2", 1)]
    d = patents.patent_documents(t).first()
    assert d["inventors"][0]["place"] == {"i": "Here", "C": "US"} and d["inventors"][0]["nationality"] is None and len(d["citations"]) == 1
    assert ("/us-patent-grant/abstract", 1) in rows(markup.tag_paths(docs))


def test_line_sources(spark, tmp_path):
    (tmp_path / "x_1.txt").write_bytes(b"a\tb\0\r\n\r\n1\t2\t3\r\n4\n")
    whole = texts.texts(spark, str(tmp_path))
    ls = texts.lines(whole)
    d = texts.delimited(ls.where("pos > 0"), "line", ["a", "b"])
    assert [(r["a"], r["b"]) for r in d.orderBy("pos").collect()] == [("1", "2"), ("4", None)]
    assert ls.select(texts.name_parts(F.col("file")).alias("p")).first()["p"] == ["x", "1"]
    prose = files(spark, ("f", "Survey Description:\nOne.\nTwo.\nSection 2\nab.data - First\n  goes on\ncd.txt - Second"))
    pl = texts.lines(prose)
    s = texts.prose_sections(pl, {"about": "^Survey Description:", "files": "^Section 2"})
    assert dict(rows(s, "section", "text"))["about"] == "One.\nTwo."
    assert rows(texts.glossary(pl.where("pos > 3")), "name", "text") == [("ab.data", "First goes on"), ("cd.txt", "Second")]


def test_loading_twice_adds_nothing(spark, tmp_path):
    schema, keys = "k int, v string", ["k"]
    go = lambda: load_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ledger", schema, keys, [F.col("v")])
    spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    go()
    go()
    assert rows(loaded(spark, f"{tmp_path}/out"), "k", "v") == [(1, "a"), (2, "c")]
    spark.createDataFrame([(2, "z"), (3, "d")], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    go()
    assert rows(loaded(spark, f"{tmp_path}/out"), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é", 1)], "a string, b int")
    T.write_ascii_csv(df, f"{tmp_path}/c")
    assert rows(spark.read.csv(f"{tmp_path}/c", header=True)) == [("e", "1")]
    T.write_with_metadata(df, f"{tmp_path}/m", {"units": "kg"})
    assert rows(spark.read.parquet(f"{tmp_path}/m/metadata")) == [("units", "kg")]


def test_metadata(spark):
    d = Dataset(["a"], [["x", "y"], ["x", "z"]], {"Info": ["a"]})
    assert d.slice_sets() == [(), ("x",), ("x", "y"), ("x", "z")]
    df = spark.createDataFrame([(1, "q"), (1, "r"), (2, "s")], "a int, b string")
    assert rows(d.violations(df)) == [(1, 2)] and d.select(df, "Info").columns == ["a"]
    series = spark.createDataFrame([(1, "Wages in steel mills"), (2, "Nothing")], "id int, title string")
    texts_ = spark.createDataFrame([("Steel mills and their wages",), ("Paper mills",)], "text string")
    assert rows(described_by_words(series, "id", "title", texts_, "text")) == [(1, "Steel mills and their wages", 3)]
    assert with_comments(df, {"a": "key"}).schema["a"].metadata == {"comment": "key"}
