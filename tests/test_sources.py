import json

import pytest

from conftest import explained, rows
from sluicework.operators import skew
from sluicework.session import register_source, ship_package
from sluicework.sinks import stores as sink_stores
from sluicework.sources import fetched, files, read_input, reports
from sluicework.sources import stores as source_stores
from sluicework.sources.xmlrecords import Walk, xml_rows


def test_csv_options():
    assert files.csv_options({}) == {"delimiter": ",", "header": "false", "inferSchema": "false"}
    asked = {"inferSchema": "TRUE", "header": "True", "delimiter": ";"}
    assert files.csv_options(asked) == {"delimiter": ";", "header": "true", "inferSchema": "true"}
    assert files.csv_options({**asked, "schema": "x"})["inferSchema"] == "false"
    assert files.csv_options({**asked, "schema_location": "x"})["inferSchema"] == "false"


def test_file_input_formats(spark, tmp_path):
    spark.range(3).write.orc(str(tmp_path / "o"))
    assert read_input(spark, {"format": "file", "path": str(tmp_path / "#day"), "day": "o"}).count() == 3
    (tmp_path / "r.avsc").write_text('{"type":"record","name":"r","fields":[{"name":"a","type":"int"},{"name":"b","type":"string"}]}')
    (tmp_path / "in.csv").write_text("1;x\n2;y\n")
    df = read_input(spark, {"format": "file", "file_format": "csv", "path": str(tmp_path / "in.csv"), "delimiter": ";",
                            "schema": "r", "schema_location": str(tmp_path)})
    assert rows(df) == [(1, "x"), (2, "y")]
    (tmp_path / "j.json").write_text('{"a":1}\n')
    assert read_input(spark, {"format": "s3", "bucket": str(tmp_path / "#file.json"), "file": "j"}).first()["a"] == 1


STORE = {"url": "u", "user": "n", "password": "p", "query": "q", "host": "h", "port": "1", "auth": "a", "timeout": "9",
         "table": "t", "key_column": "k", "nodes": "x", "index": "i", "uri": "m", "db_name": "d", "collection_name": "c",
         "pipeline": "[]", "warehouse": "w", "schema": "s", "credential_file": "f", "project_id": "pr", "data_set": "ds",
         "driver": "dr"}


def test_source_option_maps():
    assert source_stores.jdbc_options(STORE) == {"url": "u", "driver": "dr", "user": "n", "password": "p", "query": "q"}
    split = source_stores.jdbc_options({**STORE, "partition_column": "id", "lower_bound": "0", "upper_bound": "9", "num_partitions": "3"})
    assert split["dbtable"] == "(q) src" and split["numPartitions"] == "3" and "query" not in split
    assert source_stores.snowflake_options(STORE)["warehouse"] == "w"
    elastic = source_stores.elastic_options({**STORE, "ssl": "True", "metadata": "true"})
    assert elastic["es.net.ssl"] == "true" and elastic["es.read.metadata"] == "true" and elastic["es.query"] == "q"
    assert elastic["pushdown"] == "true" and elastic["es.nodes.wan.only"] == "true" and elastic["es.net.http.auth.user"] == "n"
    assert source_stores.mongo_uri("m", "d", "c") == "m/d.c"
    assert source_stores.mongo_options(STORE)["sampleSize"] == "500000"
    assert source_stores.redis_options(STORE)["key.column"] == "k"
    assert source_stores.bigquery_options(STORE)["materializationDataset"] == "ds"
    assert files.s3_options({"access_key": "a", "secret_key": "b"})["fs.s3a.access.key"] == "a"


def test_sink_option_maps():
    base = {"port": "9200", "nodes": "n", "index": "i"}
    plain = sink_stores.elastic_options(base)
    assert plain["es.resource"] == "i" and plain["es.net.ssl"] == "false" and plain["es.index.auto.create"] == "true"
    full = sink_stores.elastic_options({**base, "mapping_id": "id", "pipeline": "mine", "upsert": "UPSERT", "ssl": "true",
                                        "retryOnConflict": "2", "wan_only": "true", "data_only": "true", "user": "u",
                                        "password": "p", "retryCount": "3", "retryWaitTime": "4s", "ts_col": "d", "ts_format": "YYYY-MM"})
    assert full["es.ingest.pipeline"] == "mine" and full["es.write.operation"] == "upsert" and full["es.mapping.id"] == "id"
    assert full["es.resource"] == "i-{d|yyyy-MM}" and full["es.nodes.data.only"] == "true"
    assert (full["es.update.retry.on.conflict"], full["es.batch.write.retry.count"], full["es.batch.write.retry.wait"]) == ("2", "3", "4s")
    assert sink_stores.redis_options(STORE)["host"] == "h" and "timeout" not in sink_stores.redis_options(STORE)
    assert sink_stores.mongo_options(STORE) == {"connection.uri": "m", "database": "d", "collection": "c"}
    force = sink_stores.salesforce_options({"url": "l", "user": "u", "password": "p", "security_token": "t", "table_name": "o"})
    assert force["password"] == "pt" and force["version"] == "52.0"


def test_request_row():
    get = fetched.request_row({"uri": "https://h/x?a=1", "data": "b=2", "custom_headers": '{"A":"b"}', "timeouts": "100:200",
                               "userCredStr": "u:p"})
    assert get["uri"] == "https://h/x?a=1&b=2" and get["method"] == "GET" and get["timeout_ms"] == "300"
    assert json.loads(get["headers"]) == {"A": "b", "Authorization": "Basic dTpw"}
    post = fetched.request_row({"uri": "https://h/x", "data": "b=2", "method": "post"})
    assert (post["uri"], post["data"], post["method"]) == ("https://h/x", "b=2", "POST")
    assert fetched.request_row({"uri": "https://h", "data": "b=2", "method": "DELETE"})["uri"] == "https://h?b=2"


def test_oauth_header_signs_query_and_body():
    request = fetched.request_row({"uri": "https://h/x", "data": "b=2&a=x%20y", "oauthCredStr": "ck:cs:tk:ts", "userCredStr": "u:p"})
    assert "Authorization" not in json.loads(request["headers"])
    first = fetched.oauth_header(request, "n", 1)
    assert first.startswith('OAuth oauth_consumer_key="ck", oauth_nonce="n"') and 'oauth_signature="' in first
    assert first == fetched.oauth_header(request, "n", 1)
    assert first != fetched.oauth_header({**request, "uri": request["uri"] + "3"}, "n", 1)
    assert first != fetched.oauth_header({**request, "oauth": "ck:cs:tk:other"}, "n", 1)


def test_response_parts(spark):
    requests = spark.createDataFrame([("a",), ("b",)], "uri string")
    responses = fetched.fetch_responses(requests, lambda r: {"body": json.dumps({"x": r["uri"]}), "code": 200, "headers": '{"h":1}', "location": None})
    assert rows(fetched.response_rows(responses, "BODY", "x STRING")) == [("a",), ("b",)]
    assert rows(fetched.response_rows(responses, "headers")) == [(1,), (1,)]


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 8, 9, 31])
def test_last_page_probe(count):
    class Pages(fetched.PageFetcher):
        calls = 0

        def page(self, number):
            Pages.calls += 1
            return [{}] if number <= count else []

    assert Pages({}).last_page() == count
    assert Pages.calls <= 12


def test_paged_source_from_files(spark, tmp_path):
    for n, ids in ((1, [1, 2]), (2, [3]), (3, [])):
        (tmp_path / f"page-{n}.json").write_text(json.dumps([{"id": i, "t": "é"} for i in ids]))
    ship_package(spark)
    df = read_input(spark, {"format": "knowBe4", "fetcher": "sluicework.sources.fetched:JsonFilePages", "path": str(tmp_path),
                            "page-size": "2", "tmp-storage": str(tmp_path / "stage")})
    assert rows(df, "id", "t") == [(1, "é"), (2, "é"), (3, "é")]
    empty = tmp_path / "none"
    empty.mkdir()
    none = spark.read.format(register_source(spark, fetched.PagedExport)).options(fetcher="sluicework.sources.fetched:JsonFilePages", path=str(empty)).load()
    assert none.count() == 0


def test_xml(spark):
    assert reports.read_pairs("# c\na, //x\n\nb,//y/@k\n") == {"a": "//x", "b": "//y/@k"}
    with pytest.raises(ValueError):
        reports.read_pairs("a,b,c")
    doc = '<n:l xmlns:n="u"><n:rec><n:id>1</n:id></n:rec><n:rec k="2"/><n:rec><n:id>&amp;é</n:id><n:z>9</n:z></n:rec><n:rec><q/></n:rec></n:l>'
    df = spark.createDataFrame([(doc,), (None,), (" ",)], "v string")
    flat = xml_rows(df, "v", "//n:rec", {"id": "//n:rec/n:id", "k": "//n:rec/@k", "z": "//n:rec/n:z"})
    assert rows(flat) == sorted([("1", None, None), (None, "2", None), ("&é", None, "9")], key=repr)


def test_xml_paths_and_namespaces(spark):
    doc = ('<a xmlns="urn:d" xmlns:p="urn:p"><b><rec i="1"><v>x<w>y</w>z</v><rec i="2"><v>in</v></rec></rec></b>'
           '<c><rec i="3"><p:v>other</p:v></rec><p:rec i="4"><v> </v></p:rec></c></a>')

    def found(record, columns, namespaces=None):
        return Walk(record, columns, namespaces or {})(doc)

    ids = {"i": "/*/@i"}
    assert found("//rec", ids) == [["1"], ["2"], ["3"], ["4"]]
    assert found("/a/b/rec", ids) == [["1"]] and found("a/b//rec", ids) == [["1"], ["2"]]
    assert found("//b/rec", ids) == [["1"]] and found("//c/rec", ids) == [["3"], ["4"]] and found("//b/c", ids) == []
    assert found("//q:rec", ids, {"q": "urn:p"}) == [["4"]] and found("//q:*", ids, {"q": "urn:p"}) == [["4"]]
    assert found("//rec/rec", ids) == [["2"]] and found("//*/*/rec", ids) == [["1"], ["2"], ["3"], ["4"]]
    texts = {"v": "rec/v", "w": "//w/text()", "deep": "//rec//v/.", "q": "//q:v"}
    assert found("//rec", texts, {"q": "urn:p"}) == [
        ["xyz", "y", "xyz", None], ["in", None, "in", None], ["other", None, "other", "other"], [" ", None, " ", None]]
    for bad in ("", "//", "a[1]", "a/@b/c", "@x", "a/./b"):
        with pytest.raises(ValueError):
            Walk("//rec", {"x": bad}, {})
    with pytest.raises(ValueError):
        Walk("//rec/@i", ids, {})
    broken = spark.createDataFrame([(1, doc), (2, "<a><rec>"), (3, doc.replace("<b>", "<!-- > <rec> --><b>"))], "k int, v string")
    dropped = xml_rows(broken, "v", "//c/rec", ids, keep=["k"], malformed="drop")
    assert rows(dropped) == [(1, "3"), (1, "4"), (3, "3"), (3, "4")]
    with pytest.raises(Exception, match="well-formed"):
        xml_rows(broken, "v", "//rec", ids).collect()


def test_xml_source(spark, tmp_path):
    (tmp_path / "p1.xml").write_text("<a:l xmlns:a='u'><a:record><a:id>7</a:id></a:record></a:l>")
    (tmp_path / "map.csv").write_text("id,//a:record/a:id\n")
    props = {"format": "xml", "path": str(tmp_path / "p1.xml"), "xpathMap": str(tmp_path / "map.csv"), "schema_ddl": "id INT, n STRING"}
    assert rows(read_input(spark, props)) == [(7, "")]
    (tmp_path / "spaces.csv").write_text("a,other\n")
    assert read_input(spark, {**props, "recordTagPath": "//a:record", "namespacePrefixMap": str(tmp_path / "spaces.csv")}).isEmpty()
    assert read_input(spark, {**props, "pageSize": "1001"}).count() == read_input(spark, props).count()


def test_report_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Report Refresh Date,Used-Web\n2024-01-01,3\n")
    df = read_input(spark, {"format": "o365", "uri": str(tmp_path / "#name.csv"), "name": "r"})
    assert df.columns == ["ReportRefreshDate", "UsedWeb"] and df.first()["UsedWeb"] == 3


def test_json_lines_and_events(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"uid":"a"}\nbroken\n')
    df = read_input(spark, {"format": "peopleai", "path": str(tmp_path / "e.json"), "schema_ddl": "uid STRING"})
    assert rows(df) == sorted([("a",), (None,)], key=repr)
    lines = spark.createDataFrame([('{"topic":"t","replay_id":%d}' % i,) for i in (1, 2, 3)], "value string")
    assert reports.change_events(lines, "topic STRING, replay_id BIGINT", "t", 2).count() == 1
    assert reports.change_events(lines, "topic STRING, replay_id BIGINT", "t").count() == 3


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_and_null_keys_join_whole(spark, how):
    """A third of the rows on one key, a third without a key."""
    big = spark.range(6000).selectExpr("CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE id END AS k", "id")
    lookup = spark.range(5000).selectExpr("id AS k", "id * 2 AS v")
    plain = rows(big.join(lookup, ["k"], how))
    assert rows(skew.lookup_join(big, lookup, ["k"], how)) == plain
