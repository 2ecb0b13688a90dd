"""Reference-file loaders, nested shape and sinks (FIXTURES.md §5)."""

import gzip
import os

from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions.nested import from_nested, to_nested
from eventide.operators import catalog
from eventide.sinks import writers
from eventide.sources import files, kafka


def _write(path, text, encoding="latin-1", gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text.encode(encoding)
    if gz:
        data = gzip.compress(data)
    with open(path, "wb") as f:
        f.write(data)


def test_unique_tracks_short_row_and_latin1(spark, tmp_path):
    p = str(tmp_path / "tracks" / "t.txt")
    _write(p, "TR1<SEP>SO1<SEP>Beyoncé<SEP>Halo\nTR2<SEP>SO2\nTR3<SEP>SO3<SEP>A<SEP>B\n")
    ok, bad = files.read_unique_tracks(spark, str(tmp_path / "tracks"), with_rejects=True)
    rows = {r.track_id: (r.artist, r.title) for r in ok.collect()}
    assert rows == {"TR1": ("Beyoncé", "Halo"), "TR3": ("A", "B")}
    assert [r.track_id for r in bad.collect()] == ["TR2"]


def test_listen_counts_gzip_default_duration(spark, tmp_path):
    p = str(tmp_path / "lc" / "part.tsv.gz")
    _write(p, "TR1\tA\tT1\t200.5\t3\nTR2\tB\tT2\t\t4\n", gz=True)
    got = {r.track_id: (r.duration, r["count"])
           for r in files.read_listen_counts(spark, str(tmp_path / "lc"), partitions=4).collect()}
    assert got == {"TR1": (200.5, 3), "TR2": (180.0, 4)}


def test_user_agents_utf16(spark, tmp_path):
    p = str(tmp_path / "ua" / "ua.txt")
    _write(p, "name\tweight\tagent\tos\tbrowser\nx\t5\tMozilla/5.0\tMac\tSafari\n"
              "y\t7\tMozilla/4.0\tWindows\tEdge\n", encoding="utf-16")
    got = sorted(tuple(r) for r in files.read_user_agents(spark, str(tmp_path / "ua")).collect())
    assert got == [(5, "Mozilla/5.0", "Mac", "Safari"), (7, "Mozilla/4.0", "Windows", "Edge")]


def test_song_analysis_fields(spark, tmp_path):
    fields = ["f%d" % i for i in range(31)]
    fields[3], fields[30] = "215.3", "TRX"
    _write(str(tmp_path / "an" / "a.txt"), "  ".join(fields) + "\n")
    r = files.read_song_analysis(spark, str(tmp_path / "an")).collect()
    assert [(x.track_id, x.duration) for x in r] == [("TRX", 215.3)]


def test_postal_duplicate_zip_keeps_last_line(spark, tmp_path):
    _write(str(tmp_path / "postal" / "p.tsv"),
           "US\t10001\tNew York\tx\tNY\nUS\t10001\tManhattan\tx\tNY\nUS\t02139\tCambridge\tx\tMA\n")
    _write(str(tmp_path / "gaz" / "g.tsv"),
           "zip\tpop\ta\tb\tc\td\te\tlat\tlon\n10001\t100\t.\t.\t.\t.\t.\t40.7\t-74.0\n"
           "02139\t50\t.\t.\t.\t.\t.\t42.4\t-71.1\n")
    postal = files.read_postal(spark, str(tmp_path / "postal"))
    gaz = files.read_gazetteer(spark, str(tmp_path / "gaz"))
    got = {r.zip: (r.city, r.population) for r in catalog.locations(gaz, postal).collect()}
    assert got == {"10001": ("Manhattan", 100), "02139": ("Cambridge", 50)}


def test_postal_order_is_by_file_name_then_line(spark, tmp_path):
    _write(str(tmp_path / "p" / "a.tsv"), "US\t1\tOld\tx\tNY\n" + "US\t2\tPad\tx\tNY\n" * 500)
    _write(str(tmp_path / "p" / "b.tsv"), "US\t1\tNew\tx\tNY\n")
    gaz = spark.createDataFrame([("1", 5)], "zip string, population long")
    assert [r.city for r in catalog.locations(gaz, files.read_postal(spark, str(tmp_path / "p"))).collect()] == ["New"]


def test_retain_dates_rewrites_the_last_dates(spark, tmp_path):
    df = spark.range(40).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 4).cast("int")).alias("date"))
    df.write.partitionBy("date").parquet(str(tmp_path / "all"))
    writers.retain_dates(spark, str(tmp_path / "all"), str(tmp_path / "kept"), 3)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "kept")).collect()) == list(range(28, 40))


def test_names_and_weighted_file(spark, tmp_path):
    _write(str(tmp_path / "first" / "f.csv"), "MARY,F,10\nJOHN,M,20\n")
    _write(str(tmp_path / "last" / "l.csv"), "name,rank,weight\nVAN DYKE,1,30\n")
    assert [r.name for r in files.read_first_names(spark, str(tmp_path / "first"))
            .orderBy("name").collect()] == ["John", "Mary"]
    assert [tuple(r) for r in files.read_surnames(spark, str(tmp_path / "last")).collect()] == \
        [("Van dyke", 30)]
    w = files.load_weighted(spark, str(tmp_path / "first"), thing_col=0, weight_col=2)
    assert sorted(tuple(r) for r in w.collect()) == [("JOHN", 20), ("MARY", 10)]


def test_similar_json_tree_and_missing_csv(spark, tmp_path):
    _write(str(tmp_path / "train" / "A" / "x.json"),
           '{"track_id": "T1", "similars": [["T2", 0.5], ["T3", 1]]}', encoding="utf-8")
    _write(str(tmp_path / "test" / "B" / "C" / "y.json"),
           '{"track_id": "T4", "similars": []}', encoding="utf-8")
    docs = files.read_json_tree(spark, [str(tmp_path / "train"), str(tmp_path / "test")],
                                "track_id string, similars array<array<string>>")
    pairs = sorted(tuple(r) for r in catalog.explode_similars(docs).collect())
    assert pairs == [("T1", "T2", 0.5), ("T1", "T3", 1.0)]
    assert files.read_similar_csv(spark, str(tmp_path / "absent")).count() == 0


def test_nested_round_trip(spark):
    df = spark.createDataFrame(
        [(1, 5, "paid", 0, "NextSong", 9, "Boston", 12.5, "Mozilla", "A", "S", 200.0),
         (2, 5, "free", 1, "Home", None, None, None, None, None, None, None)],
        "ts long, sessionid long, level string, iteminsession int, page string, userid long, "
        "city string, lat double, useragent string, artist string, song string, "
        "duration double")
    nested = to_nested(df)
    mt = nested.schema["userDetails"].dataType
    assert (mt.keyType, mt.valueType) == (S.DETAIL_MAP.keyType, S.DETAIL_MAP.valueType)
    back = {r.ts: r for r in from_nested(nested).collect()}
    assert (back[1].city, back[1].lat, back[1].useragent, back[1].song) == \
        ("Boston", 12.5, "Mozilla", "S")
    assert back[2].song is None and back[2].city is None


def test_tsv_writer_replaces_tabs(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", 1)], "s string, n long")
    writers.write_tsv(df, str(tmp_path / "o"))
    lines = spark.read.text(str(tmp_path / "o")).collect()
    assert [r.value for r in lines] == ["a     b\t1"]


def test_table_ddl_and_insert_by_name(spark, tmp_path):
    name = writers.create_topic_table(spark, "eventide_test", "pv_ddl", drop=True,
                                      location=str(tmp_path / "t"))
    cols = spark.table(name).columns
    assert cols[:3] == ["ts", "ts_timestamp", "offset"] and cols[-1] == "method"
    row = {c: None for c in cols}
    row.update(ts=1, offset=7, page="Home", method="GET", status=200)
    df = spark.createDataFrame([row], spark.table(name).schema)
    writers.insert_by_name(name)(df.select(*reversed(cols)), 0)   # order does not matter
    got = spark.table(name).collect()
    assert len(got) == 1 and got[0].page == "Home" and got[0].method == "GET"
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_kafka_options_and_split(spark):
    opts = kafka.kafka_options("b:9092", S.TOPICS, "earliest")
    assert opts["subscribe"] == ",".join(S.TOPICS) and opts["startingOffsets"] == "earliest"
    rows = spark.createDataFrame([("page_view_events",), ("auth_events",), ("auth_events",)],
                                 "topic string")
    parts = kafka.split_topics(rows)
    assert parts["auth_events"].count() == 2 and parts["listen_events"].count() == 0
    shaped = kafka.to_kafka_shape(spark.createDataFrame([("{}", 3)], "value string, id long"),
                                  "listen_events", key_col="id", offset_col="id")
    assert shaped.schema.fieldNames() == S.KAFKA_SCHEMA.fieldNames()
