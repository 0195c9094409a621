import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_helpers import rows
from lakeops.functions import calendar as cal
from lakeops.sources import documents as X
from lakeops.sources.landing import bronze_frame, landing_inventory
from lakeops.sources.rescue import parse_with_rescue, recover_field
from lakeops.sources.triage import triage
from lakeops.streaming.bronze import bronze_stream

REC = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_rescue_catches_unknown_wrong_type_and_case(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "oops", "b": "x"}',), ('{"A": 2}',),
                                ('{"a": 3, "n": {"deep": 1}}',)], "t string")
    typed, rescued = parse_with_rescue(F.col("t"), REC, root="data")
    got = [r[0] for r in df.select(rescued).collect()]
    assert got[0] is None
    assert json.loads(got[1]) == {"data": [{"a": "oops"}]}
    assert json.loads(got[2]) == {"data": [{"A": "2"}]}
    assert json.loads(got[3]) == {"data": [{"n": '{"deep":1}'}]}
    back = df.select(recover_field(rescued, "a", "string").alias("a")).collect()
    assert back[1].a == "oops"


def test_pretty_and_one_line_documents_both_load(spark, tmp_path):
    env = {"_ingest_timestamp": "t", "_source": "s", "_endpoint": "e", "_ticker": "K", "_batch_date": "20240101",
           "data": [{"a": 1, "b": "x"}, {"a": 2, "b": "y", "extra": True}]}
    pretty, lines = tmp_path / "pretty", tmp_path / "lines"
    pretty.mkdir(), lines.mkdir()
    (pretty / "K_20240101.json").write_text(json.dumps(env, indent=2))
    (lines / "K_20240101.json").write_text(json.dumps(env) + "\n" + json.dumps({**env, "data": []}) + "\n")
    for src, whole in ((pretty, True), (lines, False)):
        out = str(tmp_path / f"bronze-{src.name}")
        bronze_stream(spark, str(src), out, str(tmp_path / f"ck-{src.name}"), REC, wholetext=whole)
        b = spark.read.parquet(out)
        assert rows(b, "a", "b") == [(1, "x"), (2, "y")]
        assert b.filter("_rescued_data is not null").count() == 1
        assert b.first()._source_file.endswith("K_20240101.json")
        # a second run finds nothing new
        bronze_stream(spark, str(src), out, str(tmp_path / f"ck-{src.name}"), REC, wholetext=whole)
        assert spark.read.parquet(out).count() == 2


def test_landing_inventory_shapes(spark):
    paths = spark.createDataFrame([("r/feed_a/profile/BRK_B_20240101.json",), ("r/feed_a/profile/AAPL_2024010.json",),
                                   ("r/feed_a/profile/AAPL_20240101.txt",), ("r/feed_b/x/MSFT_20240102.json",)], "path string")
    got = rows(landing_inventory(paths), "source", "endpoint", "key", "batch_date")
    assert got == [("feed_a", "profile", "BRK_B", "20240101"), ("feed_b", "x", "MSFT", "20240102")]
    assert landing_inventory(paths, source="feed_b", limit=1).count() == 1


def test_triage_statuses(spark):
    df = spark.createDataFrame([("[]",), ('{"Error Message": "bad"}',), ('{"Note": "slow"}',),
                                ('{"Information": "premium"}',), ('[{"a":1}]',), ("{oops",)], "p string")
    status, msg = triage(F.col("p"))
    assert [r[0] for r in df.select(status).collect()] == [
        "empty", "error_in_body", "throttled", "throttled", "success", "error"]


def test_calendar_size_and_flags(spark):
    dd = cal.date_dimension(spark, "1960-01-01", "2030-12-31")
    assert dd.count() == 25932
    assert str(dd.agg(F.max("date_day")).first()[0]) == "2030-12-30"
    hol = cal.holidays(cal.days(spark, "2015-01-01", "2031-01-01"))
    assert hol.count() == 153
    flags = {str(r.date_day): (r.is_weekday, r.is_holiday, r.is_market_open) for r in
             dd.filter("date_day in ('2024-02-29', '2021-07-05', '2021-07-04', '2022-01-01', '2010-12-24')").collect()}
    assert flags["2024-02-29"] == (True, False, True)
    assert flags["2021-07-05"] == (True, True, False)      # observed Monday
    assert flags["2021-07-04"] == (False, False, False)    # Sunday, the holiday itself moved
    assert flags["2022-01-01"] == (False, False, False)    # Saturday New Year, not moved to Friday
    assert flags["2010-12-24"] == (True, True, False)      # Christmas on a Saturday, observed on Friday
    # any year has holidays; a table's years can limit them
    assert cal.holidays(cal.days(spark, "2035-01-01", "2036-01-01")).count() >= 9
    assert cal.holidays(cal.days(spark, "2010-01-01", "2040-01-01"), years=(2015, 2030)).count() == 153


def test_filings_are_stored_small_and_whole(spark, tmp_path):
    """Tags are most of a filing: what is written is a fraction of its text, and every filing is read back."""
    from lakeops.sources import documents as X
    owner = F.struct(*X.nested(X.OWNER, {k: F.lit("a name") for k in X.OWNER}))
    docs = spark.range(0, 3000, 1, 2).select(F.col("id").cast("string").alias("accession"), F.lit("4").alias("documentType"), F.array(owner).alias("reportingOwner"),
                                             F.struct(F.array(F.struct(*X.nested(X.COMMON, {k: F.col("id") for k in X.COMMON}))).alias("nonDerivativeTransaction")).alias("nonDerivativeTable"))
    X.write_filings(docs, str(tmp_path / "filings"))
    files = [f for f in (tmp_path / "filings").iterdir() if f.name.startswith("part-")]
    assert len(files) >= 2 and sum(f.stat().st_size for f in files) < 3000 * 200
    lines = X.flatten_filings(X.read_filings(spark, str(tmp_path / "filings")))
    assert sorted(int(r[0]) for r in lines.select("accession").collect()) == list(range(3000))
    assert lines.where("security_title = accession and rpt_owner_name = 'a name'").count() == 3000
    # one pass over the files for both tables, though a filing may lack either
    assert lines._jdf.queryExecution().sparkPlan().toString().count("FileScan xml") == 1


FILING = """<filings><ownershipDocument>
 <schemaVersion>X0508</schemaVersion><accession>a1</accession><documentType>4</documentType><periodOfReport>2024-01-02</periodOfReport>
 <issuer><issuerCik>0000000011</issuerCik><issuerName>Acme</issuerName><issuerTradingSymbol>ACM</issuerTradingSymbol></issuer>
 <reportingOwner><reportingOwnerId><rptOwnerCik>21</rptOwnerCik><rptOwnerName>first</rptOwnerName></reportingOwnerId>
  <reportingOwnerRelationship><isDirector>1</isDirector><isOfficer>0</isOfficer><officerTitle> </officerTitle>
   <isTenPercentOwner>0</isTenPercentOwner><isOther>0</isOther></reportingOwnerRelationship></reportingOwner>
 <reportingOwner><reportingOwnerId><rptOwnerCik>22</rptOwnerCik><rptOwnerName>second</rptOwnerName></reportingOwnerId></reportingOwner>
 <nonDerivativeTable>
  <nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2024-01-02</value></transactionDate>
   <transactionCoding><transactionFormType>4</transactionFormType><transactionCode>S</transactionCode>
    <equitySwapInvolved>0</equitySwapInvolved></transactionCoding>
   <transactionAmounts><transactionShares><value>  </value></transactionShares>
    <transactionPricePerShare><value>12.5</value><footnoteId id="F1"/></transactionPricePerShare>
    <transactionAcquiredDisposedCode><value>D</value></transactionAcquiredDisposedCode></transactionAmounts>
   <postTransactionAmounts><sharesOwnedFollowingTransaction><value>90</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
   <ownershipNature><directOrIndirectOwnership><value>I</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>
  <nonDerivativeHolding><securityTitle><value>Common</value></securityTitle></nonDerivativeHolding>
 </nonDerivativeTable>
 <derivativeTable><derivativeTransaction><securityTitle><value>Option</value></securityTitle>
   <conversionOrExercisePrice><value>3.5</value></conversionOrExercisePrice><exerciseDate><value>2025-01-01</value></exerciseDate>
   <expirationDate><value>2030-01-01</value></expirationDate><underlyingSecurity><underlyingSecurityTitle><value>Common</value>
   </underlyingSecurityTitle><underlyingSecurityShares><value>100</value></underlyingSecurityShares></underlyingSecurity>
 </derivativeTransaction></derivativeTable>
</ownershipDocument>
<ownershipDocument><accession>a2</accession><documentType>4/A</documentType></ownershipDocument></filings>"""


def test_hand_made_filing_gives_every_field(spark, tmp_path):
    (tmp_path / "f.xml").write_text(FILING)
    lines = X.flatten_filings(X.read_filings(spark, str(tmp_path)))
    got = {r.table: r.asDict() for r in lines.collect()}
    assert set(got) == {"non_derivative", "derivative"} and lines.count() == 2
    n, d = got["non_derivative"], got["derivative"]
    context = {"accession": "a1", "period_of_report": "2024-01-02", "issuer_cik": "0000000011", "issuer_name": "Acme", "issuer_symbol": "ACM",
               "rpt_owner_cik": "21", "rpt_owner_name": "first", "is_director": "1", "is_officer": "0", "officer_title": None,
               "is_ten_percent_owner": "0", "is_other": "0", "line_index": 0}
    assert all(x[k] == v for x in (n, d) for k, v in context.items())
    common = {"security_title": "Common", "transaction_date": "2024-01-02", "transaction_code": "S", "transaction_form_type": "4",
              "equity_swap_involved": "0", "transaction_shares": None, "transaction_price_per_share": "12.5",
              "acquired_disposed_code": "D", "shares_owned_following": "90", "direct_or_indirect": "I"}
    extra = {"conversion_or_exercise_price": "3.5", "exercise_date": "2025-01-01", "expiration_date": "2030-01-01",
             "underlying_security_title": "Common", "underlying_security_shares": "100"}
    assert all(n[k] == v for k, v in common.items()) and all(n[k] is None for k in extra)
    assert all(d[k] == v for k, v in extra.items()) and d["security_title"] == "Option"
    assert len(n) == 26 + 3  # and accession, table, line_index


def test_schema_inferred_from_all_files(spark, tmp_path):
    from lakeops.sources.landing import frozen_schema
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(json.dumps({"data": [{"p": 1}]}))
    (land / "b.json").write_text(json.dumps({"data": [{"p": 1.5, "q": "x"}]}))
    schema = frozen_schema(spark, str(tmp_path / "schema"), str(land))
    assert schema.simpleString() == "struct<p:double,q:string>"
    (land / "c.json").write_text(json.dumps({"data": [{"z": 1}]}))
    assert frozen_schema(spark, str(tmp_path / "schema"), str(land)) == schema


def test_rescue_at_every_depth(spark):
    from pyspark.sql import types as T
    from lakeops.sources.rescue import parse_with_rescue
    schema = T.StructType.fromDDL("a struct<b: int>, l array<struct<n: int>>, s string")
    texts = ['{"a":{"b":1,"c":2}}', '{"l":[{"n":1},{"n":2,"m":"x"}]}', '[1,"x"]', '"x"', '{"a":5}', '{"a":{"b":1},"l":[],"s":"t"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    typed, rescued = parse_with_rescue(F.col("t"), schema)
    got = [None if r[0] is None else json.loads(r[0]) for r in df.select(rescued).collect()]
    assert got[0] == {"a": '{"c":"2"}'} and json.loads(got[1]["l"]) == [None, '{"m":"x"}']
    assert got[2] == {"_value": '[1,"x"]'} and got[3] == {"_value": '"x"'} and got[4] == {"a": "5"}
    assert got[5] is None and got[6] is None


def test_one_stream_per_dataset_with_frozen_schema(spark, tmp_path):
    from lakeops.sources.landing import pack_envelopes, write_landing
    from lakeops.streaming.bronze import BronzeSpec, load_all
    recs = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "c", 12)], "k int, name string, v int")
    for endpoint in ("prices", "events"):
        env = pack_envelopes(recs, "k", F.lit("20240101"), "src", endpoint, "t0", ["k", "name", "v"], page=F.lit(0))
        write_landing(env, str(tmp_path / "landing"))
    out = load_all(spark, str(tmp_path / "landing"), str(tmp_path / "bronze"),
                   [BronzeSpec("src", "prices"), BronzeSpec("src", "events")])
    assert sorted(out) == ["src.events", "src.prices"]
    for path in out.values():
        assert spark.read.parquet(path).count() == 3
    # second run: nothing new, schema reused from its saved location
    out2 = load_all(spark, str(tmp_path / "landing"), str(tmp_path / "bronze"), [BronzeSpec("src", "prices")])
    assert spark.read.parquet(out2["src.prices"]).count() == 3


def test_time_helpers(spark):
    from lakeops.functions.keys import batch_day, iso_utc
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 6),)], "ts timestamp_ntz")
    r = df.select(iso_utc("ts").alias("i"), batch_day("ts").alias("b")).first()
    assert (r.i, r.b) == ("2024-01-02T03:04:05.000006Z", "20240102")


def test_xml_one_document_per_line(spark, tmp_path):
    docs = [f"<ownershipDocument><accession>a{i}</accession><documentType>4</documentType>"
            f"<nonDerivativeTable><nonDerivativeTransaction><transactionAmounts><transactionShares><value>{i}</value></transactionShares>"
            f"</transactionAmounts></nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>" for i in range(5)]
    (tmp_path / "many.xml").write_text("\n".join(docs) + "\n")
    lines = X.flatten_filings(X.read_filings_lines(spark, str(tmp_path / "many.xml")))
    assert sorted(r.transaction_shares for r in lines.collect()) == ["0", "1", "2", "3", "4"]


def test_list_landing_reads_paths_only(spark, tmp_path):
    from lakeops.sources.walk import list_landing
    for rel in ("feed_a/profile/AAPL_20240101.json", "feed_a/profile/BRK_B_20240102.json", "feed_a/profile/notes.txt",
                "feed_b/insider/MSFT_2024010.json"):
        f = tmp_path / rel
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("{}")
    paths = list_landing(spark, str(tmp_path))
    assert "content" not in paths.columns
    got = rows(landing_inventory(paths), "source", "key", "batch_date")
    assert got == [("profile", "AAPL", "20240101"), ("profile", "BRK_B", "20240102")] or \
        got == [("feed_a", "AAPL", "20240101"), ("feed_a", "BRK_B", "20240102")]


def test_export_cells_and_csv(spark, tmp_path):
    import csv
    import glob
    from lakeops.sources.export import export_marts, to_cells
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 2), None, dt.datetime(2024, 1, 2, 3, 4, 5))],
                               "i int, s string, d date, n string, t timestamp")
    cells = to_cells(df).first()
    assert tuple(cells) == ("1", "a", "2024-01-02", "", "2024-01-02T03:04:05")
    fine = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 3, 456789),)], "t timestamp")
    assert to_cells(fine).first().t == "2024-01-02T03:04:03.456789"
    paths = export_marts({"marts.tab_one": df}, str(tmp_path))
    assert list(paths) == ["tab_one"]
    headers, data = set(), []
    for f in glob.glob(f"{paths['tab_one']}/*.csv"):
        got = list(csv.reader(open(f)))
        if got:
            headers.add(tuple(got[0]))
            data += got[1:]
    assert headers == {("i", "s", "d", "n", "t")}
    assert [r[:4] for r in data] == [["1", "a", "2024-01-02", ""]]


def test_holiday_seed_csv_replaces_rules(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("holiday_date,holiday_name\n2024-02-29,Leap Closure\n")
    seed = cal.read_holiday_seed(spark, str(tmp_path / "seed.csv"))
    assert seed.schema.simpleString() == "struct<holiday_date:date,holiday_name:string>"
    dd = cal.date_dimension(spark, "2024-02-28", "2024-03-02", holiday_table=seed)
    flags = {str(r.date_day): r.is_market_open for r in dd.collect()}
    assert flags == {"2024-02-28": True, "2024-02-29": False, "2024-03-01": True}


def test_corrupt_document_kept_in_rescue_column(spark, tmp_path):
    env = {"_ingest_timestamp": "t", "_source": "s", "_endpoint": "e", "_ticker": "K", "_batch_date": "20240101",
           "data": [{"a": 1, "b": "x"}]}
    src = tmp_path / "land"
    src.mkdir()
    (src / "K_20240101.json").write_text(json.dumps(env) + "\n" + '{"_ticker": "K", "data": [ broken\n')
    out = str(tmp_path / "bronze")
    bronze_stream(spark, str(src), out, str(tmp_path / "ck"), REC)
    b = spark.read.parquet(out)
    assert b.count() == 2
    bad = b.filter("_ticker is null").first()
    assert json.loads(bad._rescued_data)["_corrupt_record"].startswith('{"_ticker": "K"')


def test_envelopes_are_paged_for_a_hot_key(spark):
    from lakeops.sources.landing import pack_envelopes
    recs = spark.range(2500).select(F.lit(7).alias("k"), F.col("id").alias("n"))
    env = pack_envelopes(recs, "k", F.lit("20240101"), "s", "e", "t", ["n"], order_col="n",
                         page=F.floor(F.col("n") / 1000))
    sizes = sorted(r[0] for r in env.select(F.size("data")).collect())
    assert sizes == [500, 1000, 1000]
    first = env.orderBy(F.col("data")[0]["n"]).first()
    assert [x.n for x in first.data[:3]] == [0, 1, 2]


def test_second_feed_files_are_bounded(spark, monkeypatch, tmp_path):
    """An order of 200 pages: no file holds more than a thousand documents."""
    from lakeops.plans import core
    entry = "map('1', named_struct(" + ", ".join(f"'{f}', '1'" for f in core.OHLCV_FIELDS) + "))"
    doc = f"named_struct('_ticker', string(l_orderkey), '_batch_date', '20240101', 'data', named_struct('Time Series (Daily)', {entry}))"
    docs = spark.range(1, 201).selectExpr("7L as l_orderkey", "id as page").union(spark.range(2000).selectExpr("id", "0L"))
    monkeypatch.setattr(core, "map_documents", lambda spark, d: docs.selectExpr("l_orderkey", "page", f"{doc} as doc"))
    monkeypatch.setattr(core, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert core.second_feed_files_q(spark, "").count() == 2000
    files = [json.loads(p.read_text()) for p in tmp_path.rglob("*.txt")]
    assert sum(map(len, files)) == 2200 and max(map(len, files)) <= 1000


def test_second_feed_files_lie_in_one_folder(spark, monkeypatch, tmp_path):
    """A file for each block and page, but no folder: folders would be listed one by one."""
    from lakeops.plans import core
    entry = "map('1', named_struct(" + ", ".join(f"'{f}', '1'" for f in core.OHLCV_FIELDS) + "))"
    doc = f"named_struct('_ticker', string(l_orderkey), '_batch_date', '20240101', 'data', named_struct('Time Series (Daily)', {entry}))"
    docs = spark.range(5000).selectExpr("id as l_orderkey", "0L as page", f"{doc.replace('l_orderkey', 'id')} as doc")
    monkeypatch.setattr(core, "map_documents", lambda spark, d: docs)
    monkeypatch.setattr(core, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert core.second_feed_files_q(spark, "").count() == 5000
    files = list(tmp_path.rglob("*.txt"))
    assert len(files) == 5 and {p.parent for p in files} == {tmp_path / "second-feed"}


def test_one_parse_whatever_the_depth(spark):
    """The optimised plan parses a document once; nothing else reads JSON text."""
    from lakeops.sources.landing import bronze_frame
    schema = T.StructType.fromDDL("a struct<b: struct<c: int, l: array<struct<n: int>>>>, m map<string, bigint>, s string")
    raw = spark.createDataFrame([('{"_ticker":"K","data":[{"a":{"b":{"c":1,"l":[{"n":2,"x":3}],"y":4}}}]}',)], "value string")
    plan = bronze_frame(raw, schema)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1 and "from_json" not in plan.lower() and "jsontostructs" not in plan.lower()
    got = bronze_frame(raw, schema).first()
    assert got.a.b.c == 1 and got.a.b.l[0].n == 2
    rest = json.loads(json.loads(json.loads(got._rescued_data)["data"][0]["a"])["b"])
    assert rest["y"] == "4" and json.loads(rest["l"]) == ['{"x":"3"}']


def test_values_that_do_not_fit_are_rescued(spark):
    schema = T.StructType.fromDDL("i int, d double, t date, f boolean, l array<int>, m map<string, int>, z decimal(5, 2)")
    texts = ['{"i":1.5,"d":2,"t":"2024-01-02","f":true,"l":[1,"x"],"m":{"a":1,"b":"q"},"z":1.25}',
             '{"i":"1","d":"2","t":20240102,"f":"true","l":{},"m":[1],"z":"1"}', '{"i":99999999999,"d":null,"t":"soon","l":null}', '{"i":1,"i":2}', "{oops"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    typed, rescued = parse_with_rescue(F.col("t"), schema)
    got = df.select(typed.alias("v"), rescued.alias("r")).collect()
    v, r = got[0].v, json.loads(got[0].r)
    assert (v.i, v.d, str(v.t), v.f, v.l, v.m, str(v.z)) == (None, 2.0, "2024-01-02", True, [1, None], {"a": 1, "b": None}, "1.25")
    assert r["i"] == "1.5" and json.loads(r["l"]) == [None, "x"] and json.loads(r["m"]) == {"b": "q"} and set(r) == {"i", "l", "m"}
    assert list(got[1].v) == [None] * 7 and set(json.loads(got[1].r)) == set("idtflmz")
    assert json.loads(got[2].r) == {"i": "99999999999", "t": "soon"}
    assert [(g.v, json.loads(g.r)) for g in got[3:]] == [(None, {"_value": t}) for t in texts[3:]]


def test_data_that_is_no_array_is_kept(spark):
    from lakeops.sources.landing import bronze_frame
    docs = ['{"_ticker":"K","data":{"a":1}}', '{"_ticker":"K"}', '{"_ticker":"K","data":null}', "[1]", '{"_ticker":"K","data":[]}']
    out = bronze_frame(spark.createDataFrame([(t,) for t in docs], "value string"), REC).collect()
    assert sorted(json.loads(r._rescued_data)["_corrupt_record"] for r in out) == sorted([docs[0], docs[3]])


def test_marts_are_published_together_or_not_at_all(spark, tmp_path):
    from lakeops.sources.export import TooManyCells, publish_marts, served_marts
    out = str(tmp_path / "served")
    a, b = spark.range(5).toDF("x"), spark.range(3).selectExpr("id as y", "'t' as z")
    assert served_marts(spark, out) == {}
    assert publish_marts({"m.a": a, "m.b": b}, out) == {"a": 6, "b": 8}
    read = lambda tab: sorted(r[0] for r in spark.read.option("header", True).csv(served_marts(spark, out)[tab]).collect())
    assert read("a") == list("01234") and read("b") == list("012")
    bad = spark.range(3).select(F.raise_error(F.lit("no mart")).cast("string").alias("w"))
    before = served_marts(spark, out)
    for wrong, marts, limit in ((Exception, {"m.a": a.limit(1), "m.bad": bad}, 100), (TooManyCells, {"m.a": a.limit(1), "m.b": b}, 9), (ValueError, {"m.a": a, "n.a": b}, 100)):
        with pytest.raises(wrong):
            publish_marts(marts, out, cell_limit=limit)
        assert served_marts(spark, out) == before and read("a") == list("01234")
    # a new set replaces the whole one; the one before is kept for its readers, older ones go
    for n in (1, 2):
        publish_marts({"m.a": a.limit(n)}, out)
    assert set(served_marts(spark, out)) == {"a"} and len([p for p in (tmp_path / "served").iterdir() if p.name.startswith("set-")]) == 2


def test_a_set_over_the_limit_is_spread_over_sheets(spark, tmp_path):
    """Every row is served, no sheet holds more cells than the limit."""
    from lakeops.sources.export import TooManyCells, publish_marts, served_marts
    out = str(tmp_path / "served")
    a, b = spark.range(25).repartition(2).selectExpr("id as x", "id % 3 as y"), spark.range(1).selectExpr("id as z")
    with pytest.raises(TooManyCells):
        publish_marts({"m.a": a, "m.b": b}, out, cell_limit=10)
    assert publish_marts({"m.a": a, "m.b": b}, out, cell_limit=10, spread=True) == {"a": 52, "b": 2}
    back = spark.read.option("header", True).csv(served_marts(spark, out)["a"])
    assert sorted(int(r["x"]) for r in back.collect()) == list(range(25))
    sheets = [f.read_text().split() for f in (tmp_path / "served").glob("set-*/a/part-*")]
    assert all(s[0] == "x,y" and 2 * len(s) <= 10 for s in sheets) and len(sheets) >= 7
    with pytest.raises(TooManyCells):  # not even one row
        publish_marts({"m.a": a, "m.b": b}, out, cell_limit=3, spread=True)
    assert set(served_marts(spark, out)) == {"a", "b"}


def test_documents_are_files_and_listed(spark, tmp_path):
    from lakeops.sources.walk import walk_landing, write_documents
    docs = spark.createDataFrame([(s, e, f"K{i}", f"2024010{i}", f'{{"i":{i}}}') for s in "ab" for e in ("x", "y") for i in range(1, 6)],
                                 "source string, endpoint string, key string, batch_date string, value string")
    root = str(tmp_path / "land")
    for _ in range(2):  # a task that runs again writes the same files
        assert write_documents(docs.repartition(3), root) == 20
    (tmp_path / "land" / "a" / "x" / "notes.txt").write_text("no document")
    files = walk_landing(spark, root)
    assert files.count() == 21 and files.rdd.getNumPartitions() == 4
    assert not [f for f in (tmp_path / "land").rglob("*.tmp")]
    assert rows(walk_landing(spark, root, source="a", endpoint="y"), "source", "endpoint", "file", "bytes") == [("a", "y", f"K{i}_2024010{i}.json", 7) for i in range(1, 6)]
    assert walk_landing(spark, root, source="none").count() == 0 and walk_landing(spark, str(tmp_path / "missing")).count() == 0
    got = rows(landing_inventory(files, "path", endpoint="x", limit=7), "source", "key", "batch_date")
    assert got == [("a", f"K{i}", f"2024010{i}") for i in range(1, 6)] + [("b", "K1", "20240101"), ("b", "K2", "20240102")]


def test_a_failing_dataset_ends_alone(spark, tmp_path):
    from lakeops.sources.landing import landing_dir, pack_envelopes, write_landing
    from lakeops.streaming.bronze import BronzeSpec, DatasetsFailed, load_all, load_datasets
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    recs = {"p.one": spark.createDataFrame([(1, "a")], "k int, name string"), "p.two": spark.createDataFrame([(1, 2.5, [1, 2])], "k int, v double, l array<int>"),
            "q.three": spark.createDataFrame([(1, True)], "k int, flag boolean")}
    for name, df in recs.items():
        write_landing(pack_envelopes(df, "k", F.lit("20240101"), *name.split("."), "t0", df.columns, page=F.lit(0)), landing)
    spark.range(1).selectExpr("'not json' as value").write.text(landing_dir(landing, "p", "broken"))
    specs = [BronzeSpec("p", "one"), BronzeSpec("p", "broken"), BronzeSpec("p", "missing"), BronzeSpec("p", "two"), BronzeSpec("q", "three")]
    # a stream that fails while it runs: its table can't hold what the schema says
    schemas = {"p.two": T.StructType.fromDDL("k int, _ticker string")}
    got = {x.name: x for x in load_datasets(spark, landing, bronze, specs, schemas, at_once=2)}
    assert [n for n, x in got.items() if x.error] == ["p.broken", "p.missing", "p.two"]
    for name in ("p.one", "q.three"):
        cols = recs[name].columns
        assert rows(spark.read.parquet(got[name].table), *cols) == rows(recs[name].selectExpr(*cols))
    # mended, it goes on; the others find nothing new
    with pytest.raises(DatasetsFailed, match="p.broken"):
        load_all(spark, landing, bronze, specs)
    assert spark.read.parquet(got["p.two"].table).count() == 1 and spark.read.parquet(got["p.one"].table).count() == 1


def test_served_sheets_may_be_compressed(spark, tmp_path):
    """The same rows are served from less disk, each sheet within the limit."""
    import glob
    import gzip
    import os
    from lakeops.sources.export import publish_marts, served_marts
    df = spark.range(3000).selectExpr("id as x", "cast(date'2024-01-31' as string) as y")
    sizes, back, cells = [], [], []
    for codec in (None, "gzip"):
        out = str(tmp_path / f"served-{codec}")
        cells.append(publish_marts({"m.a": df}, out, cell_limit=2000, spread=True, compression=codec))
        path = served_marts(spark, out)["a"]
        files = glob.glob(f"{path}/part-*")
        sizes.append(sum(os.path.getsize(f) for f in files))
        back.append(sorted(map(tuple, spark.read.option("header", True).csv(path).collect())))
        sheets = [(gzip.open if codec else open)(f, "rt").read().split() for f in files]
        assert all(s[0] == "x,y" and 2 * len(s) <= 2000 for s in sheets)
    assert back[0] == back[1] and len(back[0]) == 3000 and cells[0] == cells[1] and sizes[1] < sizes[0] / 3


def test_filings_are_written_without_indentation(spark, tmp_path):
    """Whitespace between tags is neither written nor parsed; text keeps its own."""
    import glob
    import gzip
    nodes = X.nested(X.DOCUMENT, {k: F.lit(f" {k}  x ") for k in X.DOCUMENT})
    docs = spark.range(5).select(F.col("id").cast("string").alias("accession"), F.lit("4").alias("documentType"), *nodes)
    X.write_filings(docs, str(tmp_path / "f"))
    text = "".join(gzip.open(f, "rt").read() for f in glob.glob(str(tmp_path / "f" / "part-*")))
    assert text.count("<ownershipDocument>") == 5 and "> <" not in text and "    <" not in text
    back = X.read_filings(spark, str(tmp_path / "f"))
    assert sorted(r.accession for r in back.collect()) == list("01234")
    assert {r.issuer.issuerName.strip() for r in back.collect()} == {"issuer_name  x"}
