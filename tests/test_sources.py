from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from strataflow.plans.hospital.ingest import feeds
from strataflow.sources.files import FILE, INGESTED, new_files, stream_csv_feed
from strataflow.sources.landing import CsvFeed, Feed, land, land_all, landed_rows, write_load
from strataflow.session import read_or_none
from strataflow.sources.ledger import Ledger
from strataflow.sources.relational import footer_mark, high_water_mark, incremental_rows, jdbc_table, newer_rows, split_predicates
from strataflow.sources.schema import landing_columns, landing_type, without_technical

NOW = datetime(2024, 1, 1)


def test_landing_types():
    pairs = [
        (T.ShortType(), T.LongType()), (T.IntegerType(), T.LongType()), (T.FloatType(), T.DoubleType()),
        (T.DecimalType(8, 2), T.DecimalType(8, 2)), (T.DateType(), T.DateType()),
        (T.TimestampType(), T.TimestampType()), (T.BooleanType(), T.BooleanType()),
        (T.StringType(), T.StringType()), (T.VarcharType(5), T.StringType()), (T.BinaryType(), T.StringType()),
    ]
    assert [landing_type(a) for a, _ in pairs] == [b for _, b in pairs]


def test_landing_columns_and_technical(spark):
    df = spark.createDataFrame([(1, "x", "y")], "IdOrden int, NumeroOrden string, _DLT_ID string")
    landed = landing_columns(df)
    assert landed.dtypes == [("id_orden", "bigint"), ("numero_orden", "string"), ("_dlt_id", "string")]
    assert without_technical(landed).columns == ["id_orden", "numero_orden"]


def _rows(spark, *data):
    stamped = [(k, datetime(2024, 1, 1, 0, 0, s, us)) for k, s, us in data]
    return spark.createDataFrame(stamped, "k int, cursor timestamp")


def test_incremental_rows_miss_nothing_at_the_mark(spark, rows):
    landed = _rows(spark, (1, 0, 0), (2, 5, 0))
    source = _rows(spark, (1, 0, 0), (2, 5, 0), (3, 5, 0), (4, 5, 500), (5, 9, 0))
    mark = high_water_mark(landed, "cursor")
    assert [r[0] for r in rows(incremental_rows(source, landed, "cursor", ["k"]), "k")] == [3, 4, 5]
    # one millisecond past the mark, as the source system read: rows 3 and 4 are skipped
    assert [r[0] for r in rows(newer_rows(source, "cursor", mark, parity=True), "k")] == [5]
    assert newer_rows(source, "cursor", None).count() == 5
    assert high_water_mark(None, "cursor") is None and high_water_mark(landed.limit(0), "cursor") is None


def test_cursor_filter_reaches_the_scan(spark, tmp_path):
    _rows(spark, (1, 0, 0), (2, 5, 0)).write.parquet(f"{tmp_path}/t")
    source = spark.read.parquet(f"{tmp_path}/t")
    plan = newer_rows(source, "cursor", "2024-01-01 00:00:03")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(cursor" in plan


def test_an_empty_load_is_not_entered(spark, tmp_path):
    feed = Feed("t", lambda s: _rows(s, (1, 0, 0)).filter("k > 1"), "cursor", ("k",))
    assert land(spark, feed, str(tmp_path), NOW) is False
    assert Ledger(spark, str(tmp_path), "t").loads() == {} and landed_rows(spark, str(tmp_path), "t").count() == 0
    assert read_or_none(spark, f"{tmp_path}/nothing") is None


def test_tables_land_incrementally(spark, tmp_path):
    first, second = _rows(spark, (1, 0, 0)), _rows(spark, (1, 0, 0), (2, 3, 0), (3, 0, 0))
    feed = lambda df: Feed("t", lambda _: df, "cursor", ("k",))
    root = str(tmp_path)
    assert land(spark, feed(first), root, NOW) is True
    assert land(spark, feed(first), root, NOW) is False
    assert land(spark, feed(second), root, NOW) is True  # another row of the mark's own instant
    assert sorted(r.k for r in landed_rows(spark, root, "t").collect()) == [1, 2, 3]
    assert land(spark, feed(_rows(spark, (4, 2, 0), (5, 10, 0))), root, NOW) is True
    assert sorted(r.k for r in landed_rows(spark, root, "t").collect()) == [1, 2, 3, 5]
    assert INGESTED in landed_rows(spark, root, "t").columns
    marks = Ledger(spark, root, "t").loads()
    assert sorted(marks) == [0, 1, 2] and marks[2].startswith("2024-01-01 00:00:10")


def test_a_load_that_was_cut_off_is_repeated_in_full(spark, tmp_path):
    root, feed = str(tmp_path), Feed("t", lambda s: _rows(s, (1, 0, 0), (2, 5, 0)), "cursor", ("k",))
    # rows without an entry in the ledger
    write_load(_rows(spark, (2, 5, 0)).withColumn(INGESTED, F.lit(NOW)), Ledger(spark, root, "t").folder(0))
    assert land(spark, feed, root, NOW) is True
    assert sorted(r.k for r in landed_rows(spark, root, "t").collect()) == [1, 2]
    folder = tmp_path / "in"
    folder.mkdir()
    _deliver(spark, folder, "a.csv", "1;x", "2;y")
    csv = CsvFeed("productos", str(folder))
    write_load(spark.createDataFrame([("1", "x", "a.csv")], "codigo string, nombre string, fichero_origen string"), Ledger(spark, root, "productos").folder(0))
    assert land(spark, csv, root, NOW) is True and land(spark, csv, root, NOW) is False
    assert sorted(r.codigo for r in landed_rows(spark, root, "productos").collect()) == ["1", "2"]


def test_what_is_new_is_told_without_reading_what_is_landed(spark, tmp_path):
    folder, root = tmp_path / "in", f"{tmp_path}/out"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        _deliver(spark, folder, name, "1;x")
        assert land(spark, CsvFeed("productos", str(folder)), root, NOW) is True
    ledger = Ledger(spark, root, "productos")
    assert all("/ledger/productos/" in f for f in ledger.files().inputFiles())
    # a landed table that cannot be read any more is not asked
    for f in (tmp_path / "out" / "productos").rglob("*.parquet"):
        f.write_bytes(b"no parquet")
    assert new_files(spark, str(folder), ledger.files()) == []


def test_marks_come_from_footers_where_they_can(spark, tmp_path):
    days = spark.range(50).select("id", F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("dia"),
                                  F.timestamp_seconds("id").alias("cuando"), F.col("id").cast("string").alias("texto"))
    days.write.parquet(f"{tmp_path}/t")
    for column, mark, pushed in (("id", "49", True), ("dia", "2024-02-19", True), ("cuando", "1970-01-01 00:00:49", False), ("texto", "9", False)):
        found = footer_mark(spark, f"{tmp_path}/t", column)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert (f"PushedAggregation: [MAX({column})]" in plan) == pushed
        assert found.first()[0] == mark
    assert "" != spark.conf.get("spark.sql.sources.useV1SourceList")


class _Reader:
    """Stands for a database: keeps what it is asked for."""

    def __init__(self, bounds):
        self.bounds, self.asked, self.read = bounds, [], self

    def format(self, kind):
        self.asked.append({"format": kind})
        return self

    def options(self, **given):
        self.asked[-1].update(given)
        return self

    def option(self, key, value):
        self.asked[-1][key] = value
        return self

    def load(self):
        return self

    def collect(self):
        return [(b,) for b in self.bounds]

    def jdbc(self, url, table, predicates, properties):
        self.asked.append({"url": url, "table": table, "predicates": predicates, "properties": properties})
        return self


def test_first_load_is_split_into_equal_parts():
    db = _Reader([700, 1, 40])
    jdbc_table(db, {"url": "jdbc:x", "user": "u"}, "Equipos", "id_equipo", 3)
    bounds, table = db.asked
    assert "NTILE(3) OVER (ORDER BY id_equipo)" in bounds["query"] and bounds["url"] == "jdbc:x"
    assert table == {
        "url": "jdbc:x", "table": "Equipos", "properties": {"user": "u"},
        "predicates": ["id_equipo < 40 OR id_equipo IS NULL", "id_equipo >= 40 AND id_equipo < 700", "id_equipo >= 700"],
    }
    single = _Reader([])
    jdbc_table(single, {"url": "jdbc:x"}, "Equipos")
    assert single.asked == [{"format": "jdbc", "url": "jdbc:x", "dbtable": "Equipos"}]
    assert split_predicates("k", []) == ["1 = 1"]
    assert split_predicates("k", ["o'x", "o'x", "z"]) == ["k < 'o''x' OR k IS NULL", "k >= 'o''x' AND k < 'z'", "k >= 'z'"]


def test_split_predicates_meet_every_row_once(spark):
    keys = spark.createDataFrame([(k,) for k in [None, -5, 0, 1, 7, 7, 8, 100]], "k int")
    parts = split_predicates("k", [0, 7, 7, 50])
    assert len(parts) == 4 and sum(keys.filter(p).count() for p in parts) == keys.count()


def test_hospital_feeds_split_their_first_load():
    db = _Reader([5, 9])
    feed = feeds({"equipment": {"url": "jdbc:x"}})[3]
    feed.read_all(db)
    assert db.asked[1]["predicates"][0] == "id_equipo < 9 OR id_equipo IS NULL"
    db.asked.clear()
    feed.read(db)
    assert db.asked == [{"format": "jdbc", "url": "jdbc:x", "dbtable": "Equipos"}]


def test_one_failing_source_does_not_stop_the_others(spark, tmp_path):
    def broken(_):
        raise ConnectionError("no route")

    feeds = [Feed("mala", broken, "cursor", ("k",)), Feed("buena", lambda s: _rows(s, (1, 0, 0)), "cursor", ("k",))]
    outcome = land_all(spark, feeds, str(tmp_path), NOW)
    assert isinstance(outcome["mala"], ConnectionError) and outcome["buena"] is True


def _deliver(spark, folder, name, *lines):
    (folder / name).write_text("codigo;nombre\n" + "\n".join(lines) + "\n", encoding="utf-8")


def test_csv_files_land_once(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    feed = CsvFeed("productos", str(folder))
    _deliver(spark, folder, "a+b ñ.csv", "1;Gasa ñ", "2;")
    (folder / "leeme.txt").write_text("no")
    assert land(spark, feed, f"{tmp_path}/out", NOW) is True
    _deliver(spark, folder, "c.csv", "3;Venda")
    assert len(new_files(spark, str(folder), Ledger(spark, f"{tmp_path}/out", "productos").files())) == 1
    assert land(spark, feed, f"{tmp_path}/out", NOW) is True
    assert land(spark, feed, f"{tmp_path}/out", NOW) is False
    landed = landed_rows(spark, f"{tmp_path}/out", "productos")
    assert rows(landed, "codigo", "nombre", FILE) == [
        ("1", "Gasa ñ", "a+b ñ.csv"), ("2", None, "a+b ñ.csv"), ("3", "Venda", "c.csv"),
    ]


def test_csv_stream_remembers_files(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, line in (("a.csv", "1;x"), ("b.csv", "2;y")):
        _deliver(spark, folder, name, line)
        stream = stream_csv_feed(spark, str(folder), ["codigo", "nombre"])
        (
            stream.writeStream.format("parquet").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        )
    landed = spark.read.parquet(f"{tmp_path}/out")
    assert rows(landed, "codigo", FILE) == [("1", "a.csv"), ("2", "b.csv")]
    assert landed.filter(F.col(INGESTED).isNull()).isEmpty()


def test_csv_files_are_read_by_their_own_header(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('codigo;nombre\n1;"tres ""x"" fin"\n2;"dos\nlineas; una"\n', encoding="utf-8")
    (folder / "b.csv").write_text('nombre;codigo;extra\n"";3;\n;4;e\n', encoding="utf-8")
    assert land(spark, CsvFeed("productos", str(folder)), f"{tmp_path}/out", NOW) is True
    landed = landed_rows(spark, f"{tmp_path}/out", "productos")
    assert rows(landed, "codigo", "nombre", "extra") == [
        ("1", 'tres "x" fin', None), ("2", "dos\nlineas; una", None), ("3", "", None), ("4", None, "e"),
    ]


def test_csv_stream_stops_at_another_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("nombre;codigo\nx;1\n", encoding="utf-8")
    query = (
        stream_csv_feed(spark, str(folder), ["codigo", "nombre"]).writeStream.format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    )
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert not list((tmp_path / "out").glob("*.parquet"))
