"""Files in and out."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mendwork.functions.nulls import NullPolicy
from mendwork.plans import transactions as tx
from mendwork.session import materialise, shared_folder
from mendwork.sources import delimited, publish, readers, sinks

CSV = """id,status,time,card_type,city,amount,extra
54.0, Success ,2025-09-08 23:17:00,Visa,THR,100,x
54,fail,12:00,,NULL,-5000,y
7,succeed,07:32 2025-09-20,Vsa,n/a,one hundred,z
"""


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_is_read_as_text_with_null_tokens(spark, csv_path):
    df = readers.load_transactions(spark, csv_path)
    assert {t for _, t in df.dtypes} == {"string"}
    assert [r.city for r in df.collect()] == ["THR", None, None]
    assert [r.card_type for r in df.collect()] == ["Visa", None, "Vsa"]


def test_csv_without_policy_keeps_the_texts(spark, csv_path):
    df = readers.load_transactions(spark, csv_path, policy=None)
    assert [r.city for r in df.collect()] == ["THR", "NULL", "n/a"]
    assert [r.card_type for r in df.collect()] == ["Visa", "", "Vsa"]
    assert [r.status for r in df.collect()][0] == " Success "


def test_missing_columns_are_named(spark, csv_path):
    with pytest.raises(ValueError, match="total"):
        readers.read_table(spark, csv_path, required=["id", "total"])
    with pytest.raises(ValueError, match=r"\['id'\]"):
        readers.require_id_column(readers.read_table(spark, csv_path), "transaction_key")


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_tables_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    sinks.write_tables({"one": df, "two": df}, str(tmp_path), fmt)
    for name in ("one", "two"):
        back = readers.read_table(spark, f"{tmp_path}/{name}", fmt)
        assert sorted(map(tuple, back.select("k", "v").collect())) == [("1", "a"), ("2", "b")]
    sinks.write_tables({"three": df}, str(tmp_path), fmt, write=False)
    assert not (tmp_path / "three").exists()


def test_exports(spark, csv_path, tmp_path):
    raw = readers.load_transactions(spark, csv_path)
    options = tx.Options(order_by=["id", "time"], max_year=2026)
    sinks.write_csv(sinks.cleansed_view(tx.cleanse(raw, options)), str(tmp_path / "clean"))
    clean = {tuple(r) for r in readers.read_table(spark, str(tmp_path / "clean"), policy=None).collect()}
    assert ("54", "fail", "12:00 NULL", "NULL", "NULL", "-5000") in clean
    assert ("54", "Success", "2025-09-08 23:17:00", "Visa", "THR", "100") in clean

    result = tx.run(raw, options)
    sinks.write_csv(sinks.transformed_view(result.frame), str(tmp_path / "transformed"))
    out = readers.read_table(spark, str(tmp_path / "transformed"), policy=None)
    assert out.columns == ["id", "transaction_id", "status", "date", "time", "card_type", "city", "amount"]
    rows = {(r.id, r.time): tuple(r) for r in out.collect()}
    assert rows["7", "07:32:00"][2:] == ("success", "2025-09-20", "07:32:00", "Visa", "NULL", "100.0")


def test_documents(spark, csv_path, tmp_path):
    raw = readers.load_transactions(spark, csv_path)
    sinks.write_document(tx.profile_document(raw), str(tmp_path / "profile"))
    profile = json.loads(next(Path(tmp_path / "profile").glob("*.json")).read_text())
    assert profile["rows"] == 3 and profile["missing_by_col"]["city"] == 2
    assert profile["duplicated_id_rows"] == 0 and profile["valid_amount_rows"] == 3
    frame = tx.run(raw, tx.Options(order_by=["id", "time"], max_year=2026)).frame
    sinks.write_document(tx.metadata_document(frame, ["one"]), str(tmp_path / "metadata"))
    metadata = json.loads(next(Path(tmp_path / "metadata").glob("*.json")).read_text())
    assert metadata["notes"] == ["one"] and metadata["transforms"]["time_parsed_valid_rows"] == 2
    assert metadata["transforms"]["amount_global_median_used"] == 100.0


def test_lookup_and_first_rows(spark, tmp_path):
    (tmp_path / "city.csv").write_text("city_id,city\ncity_1,Ahvaz\ncity_2,Isfahan\n")
    lookup = readers.read_lookup(spark, str(tmp_path / "city.csv"))
    assert {r.city: r.city_id for r in lookup.collect()} == {"Ahvaz": "city_1", "Isfahan": "city_2"}
    assert [r.id for r in readers.first_rows(spark.range(100).orderBy(F.desc("id")), ["id"], 3).collect()] == [0, 1, 2]


def test_null_policy_on_typed_columns(spark):
    df = spark.createDataFrame([(1, "NA"), (2, "x")], "a int, b string")
    assert [r.b for r in readers.apply_null_policy(df, NullPolicy.NA_TOKENS).orderBy("a").collect()] == [None, "x"]


def test_materialise_uses_the_shared_folder(spark):
    df = materialise(spark.range(10).withColumn("x", F.col("id") * 2), "probe")
    assert df.agg(F.sum("x")).first()[0] == 90
    assert all(f.startswith(("file:", "/")) and shared_folder(spark) in f for f in df.inputFiles())


ODD_CSV = (
    'id,status,time,card_type,city,amount\n'
    '1,success,12:00,Visa,"Te ""q"" hran",1\n'
    '2,success,12:00,"Vi\nsa","Kar\naj", 2 \n'
    '3,success,12:00\n'
    '4,success,12:00,Visa,Qom,4,seventh\n'
    '\n'
    '5,a,b,c,d,e,\n'
    '6,"x, y","","""","a""",5" pipe\n'
)


def test_csv_with_quotes_line_breaks_short_and_long_rows(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text(ODD_CSV)
    parted = readers.load_transactions_parted(spark, str(path), policy=None)
    assert sorted(map(tuple, parted.rows.collect())) == [
        ("1", "success", "12:00", "Visa", 'Te "q" hran', "1"),
        ("2", "success", "12:00", "Vi\nsa", "Kar\naj", " 2 "),
        ("3", "success", "12:00", None, None, None),
        ("6", "x, y", "", '"', 'a"', '5" pipe'),
    ]
    bad = parted.quarantine.orderBy("row_text").collect()
    assert [(r.row_text.strip(), r.n_fields, r.expected_fields, r.problem) for r in bad] == [
        ("4,success,12:00,Visa,Qom,4,seventh", 7, 6, "too many fields"),
        ("5,a,b,c,d,e,", 7, 6, "too many fields"),
    ]
    assert all(r.file.endswith("odd.csv") for r in bad)
    # Fewer columns and plain counts see the same rows.
    assert parted.rows.select("id").count() == 4
    with pytest.raises(Exception, match="unreadable row"):
        readers.load_transactions(spark, str(path)).collect()
    with pytest.raises(Exception, match="unreadable row"):
        readers.load_transactions(spark, str(path)).count()


def test_a_quote_without_end(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b,c\n1,2,3\n4,"5,6\n7,8,9\n')
    parted = delimited.read_parted(spark, str(tmp_path / "open.csv"))
    assert [tuple(r) for r in parted.rows.collect()] == [("1", "2", "3")]
    assert [r.problem for r in parted.quarantine.collect()] == ["quote without end"]


def test_csv_with_another_separator_and_several_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f'a;b\n{i};"x;{i}"\n{i};y;z\n')
    parted = delimited.read_parted(spark, str(tmp_path), sep=";")
    assert sorted(map(tuple, parted.rows.collect())) == [(str(i), f"x;{i}") for i in range(3)]
    assert parted.quarantine.count() == 3


@pytest.mark.parametrize("write", [sinks.write_csv, lambda df, path: sinks.write_tables({"": df}, path, "csv")])
def test_csv_keeps_texts(spark, tmp_path, write):
    rows = [("  a ", 'q"uo"te', "x,y"), ("l1\nl2", '"', ""), ("\t", "b\\", "é漢")]
    write(spark.createDataFrame(rows, "a string, b string, c string"), str(tmp_path / "out"))
    back = readers.read_table(spark, str(tmp_path / "out"), policy=None)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_a_run_is_published_as_a_whole(spark, tmp_path, fmt):
    folder = str(tmp_path / "out")
    with pytest.raises(publish.Incomplete):
        publish.read_published(spark, folder)
    one = spark.createDataFrame([(1, " a ", None), (2, "b\n,", 1.5)], "k long, v string, `x y` double")
    first = publish.publish({"one": one, "two": one.limit(0)}, folder, fmt)
    broken = one.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        publish.publish({"one": one.union(one), "two": broken}, folder, fmt)
    # The failed run left files, but readers still see the first one.
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2
    tables = publish.read_published(spark, folder, verify=True)
    assert set(tables) == {"one", "two"} and tables["two"].count() == 0
    want = sorted(tuple(None if x is None else str(x) for x in r) for r in one.collect())
    assert sorted(tuple(None if x is None else str(x) for x in r) for r in tables["one"].collect()) == want
    second = publish.publish({"one": one.union(one)}, folder, fmt)
    assert second > first and set(publish.read_published(spark, folder)) == {"one"}
    assert publish.read_published(spark, folder, run=first)["one"].count() == 2
    assert publish.manifest(spark, folder).count() == 3
    # What was changed after the run is noticed.
    extra = tmp_path / "out" / "runs" / second / "one"
    one.select(*[F.col(f"`{c}`").cast("string" if fmt == "csv" else t).alias(c) for c, t in one.dtypes]).write.mode("append").format(fmt).options(header="true").save(str(extra))
    with pytest.raises(publish.Incomplete):
        publish.read_published(spark, folder, verify=True)
