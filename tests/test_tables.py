import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from riskspark import schemas
from riskspark.functions.cleaning import clean_id, clean_numeric
from riskspark.operators import lookup, ranking
from riskspark.plans import contract
from riskspark.sources import csv, tables


PAYLOAD = StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def texts(spark, values):
    return spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")


def column(df, expr):
    return [r[0] for r in df.orderBy("n").select(expr).collect()]


def test_clean_numeric(spark):
    values = [" 1 234,5 ", "1,234.5", "5.0", "5,0", "abc", "", "1d", '"12,5"', None, "-3", "+4", "1e3", "5.0.0", " 7\t", "NaN", "1.", ".5"]
    expected = [None, None, 5.0, 5.0, None, None, None, 12.5, None, -3.0, 4.0, 1000.0, 5.0, 7.0, None, 1.0, 0.5]
    assert column(texts(spark, values), clean_numeric(F.col("v"))) == expected


def test_clean_id(spark):
    values = [" 12.0", "12", "1,234", "1.234,0", "id 7", "", None, "-5", "5-3", "12.50", "9" * 30]
    assert column(texts(spark, values), clean_id(F.col("v"))) == [12, 12, 1234, 12340, 7, None, None, -5, None, 1250, None]


def test_convert(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text('cst_dim_id,a,b,c\nID,A,B,C\n 1.0,"1,5",x,1\n2,2.0,y,oops\n3,,z,n/a\n4,7,4,n/a\n', encoding="utf-8")
    rows = csv.drop_subheader(csv.read_raw_csv(spark, str(raw), "_number"), number="_number")
    assert sorted(r["b"] for r in rows.collect()) == ["4", "x", "y", "z"]
    assert csv.detect_numeric_like(rows) == ["a"]  # c: 1 of 4 is not above 0.3
    csv.convert_raw(spark, str(raw), str(tmp_path / "clean"), is_subheader=F.col("cst_dim_id") == "ID")
    got = sorted(tuple(r) for r in csv.read_raw_csv(spark, str(tmp_path / "clean")).collect())
    assert got == [("1", "1.5", "x", "1"), ("2", "2.0", "y", "oops"), ("3", None, "z", "n/a"), ("4", "7.0", "4", "n/a")]


def test_load_is_strict(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("cst_dim_id,transdate,transdatetime,amount,docno,direction,target\nx,2024-01-01,2024-01-01 00:00:00,1.00,1,d,0\n")
    with pytest.raises(Exception):
        csv.load_table(spark, str(path), schemas.TRANSACTIONS).collect()


def test_training_csv_code_page(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_bytes("docno;name;target\n1;Иванов;1\n".encode("cp1251"))
    assert tuple(csv.read_training_csv(spark, str(path)).first()) == ("1", "Иванов", 1)


def test_upsert(spark, tmp_path):
    def row(name, value):
        return spark.createDataFrame([(name, *[value] * 8)], schemas.GLOBAL_STATS)

    tables.upsert_stats(spark, None, row("a", 1.0).unionByName(row("b", 1.0)), str(tmp_path / "1"))
    merged = tables.upsert_stats(spark, str(tmp_path / "1"), row("b", 2.0).unionByName(row("c", 3.0)), str(tmp_path / "2"))
    assert {r["model_name"]: r["best_thr"] for r in merged.collect()} == {"a": 1.0, "b": 2.0, "c": 3.0}


def test_requests(spark):
    good = (7, "2024-01-01", "2024-01-01 10:00:00", 5.0, "12", 1, "t")
    rows = [good, (0, *good[1:]), (*good[:3], 0.0, *good[4:]), (*good[:4], "", *good[5:]), (7, None, *good[2:])]
    ok, bad = lookup.validate_requests(spark.createDataFrame(rows, schemas.REQUEST))
    assert ok.count() == 1
    assert sorted(r["reject_reasons"] for r in bad.collect()) == [["amount"], ["cst_dim_id"], ["docno"], ["transdate"]]


def test_lookup_takes_one_row(spark):
    day = datetime.date(2024, 1, 1)
    features = spark.createDataFrame([(7, day, 3, 30), (7, day, 1, 10), (7, day, 2, 20)], "cst_dim_id long, transdate date, docno long, f int")
    asked = spark.createDataFrame([(7, "2024-01-01", "a"), (7, "2024-01-02", "b"), (7, "junk", "c")], "cst_dim_id long, transdate string, docno string")
    got = {r["request_docno"]: (r["status"], r["f"]) for r in lookup.lookup_features(asked, features, ["docno"]).collect()}
    assert got == {"a": ("found", 10), "b": ("not_found", None), "c": ("not_found", None)}


def test_row_to_map_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(lookup.row_to_map(df).first()["features"]) == {"a": 1, "b": None}


def test_payloads(spark):
    values = ['{"features":{"a":1,"b":"x"}}', '{"features":[{"a":1},{"a":2}]}', '{"a":3}', '[{"a":4}]', '{"features":7}', "nope", '{"features":[1,2]}', None]
    good, bad = lookup.parse_feature_payload(texts(spark, values), "v", PAYLOAD)
    assert sorted((r["n"], r["item"], r["a"], r["b"]) for r in good.select("n", "item", "a", F.coalesce("b", F.lit("")).alias("b")).collect()) == [
        (0, 0, 1, "x"), (1, 0, 1, ""), (1, 1, 2, ""), (2, 0, 3, ""), (3, 0, 4, ""),
    ]
    assert sorted(r["n"] for r in bad.collect()) == [4, 5, 6, 7]


def test_prediction_path(spark):
    df = texts(spark, ['{"results":{"m":{"prediction":[0.25, 1]}}}', '{"results":{"m":{"error":"x"}}}', "junk"])
    assert column(df, lookup.parse_prediction(F.col("v"), "m")) == [0.25, None, None]


def test_versions(spark):
    rows = [
        ("a", "1", 1, True, True, "old"), ("a", "2", 2, False, False, "bad"),
        ("b", "1", 1, False, True, "x"), ("b", "2", 2, False, False, "bad"),
        ("c", "1", 1, True, True, "x"), ("c", "2", 2, False, True, "new"),
        ("d", "1", 1, True, True, "x"), ("d", "2", 2, True, False, "bad"),
    ]
    df = spark.createDataFrame(rows, "key string, version_id string, last_modified int, stable boolean, valid boolean, body string")
    got = {r["key"]: (r["status"], r["version_id"]) for r in ranking.usable_version(df).collect()}
    assert got == {"a": ("stable", "1"), "b": ("error", None), "c": ("latest", "2"), "d": ("error", None)}


def test_contract(spark):
    df = spark.createDataFrame([(1, 2.0, "x", "extra")], "docno long, amount double, direction string, zzz string")
    out = contract.project_contract(df, ["amount", "docno", "hour"])
    assert out.columns == ["amount", "docno", "missing_features"] and out.first()["missing_features"] == ["hour"]
    matrix, numeric, text = contract.prepare_matrices(df.withColumn("target", F.lit("1")))
    assert numeric == ["docno", "amount"] and text == ["zzz"] and matrix.first()["target"] == 1


def test_feature_view_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime.date(2024, 1, 1)), (2, datetime.date(2024, 1, 2))], "docno long, transdate date")
    stored = tables.write_feature_view(df, str(tmp_path / "view"))
    assert sorted(p.name for p in (tmp_path / "view").glob("transdate=*")) == ["transdate=2024-01-01", "transdate=2024-01-02"]
    assert "PartitionFilters: [isnotnull(transdate" in stored.where("transdate = DATE'2024-01-01'")._jdf.queryExecution().executedPlan().toString()


def test_load_table_binds_by_header(spark, tmp_path):
    names = ["docno", "amount", "direction", "target", "cst_dim_id", "transdatetime", "transdate", "extra"]
    path = tmp_path / "permuted.csv"
    path.write_text(",".join(names) + "\n11,5.25,d,1,22,2024-01-02 03:04:05,2024-01-02,x\n")
    (row,) = csv.load_table(spark, str(path), schemas.TRANSACTIONS).collect()
    assert (row["docno"], row["cst_dim_id"], str(row["amount"])) == (11, 22, "5.25") and list(row.asDict()) == schemas.TRANSACTIONS.fieldNames()
    path.write_text("docno,amount\n1,2\n")
    with pytest.raises(ValueError, match="cst_dim_id"):
        csv.load_table(spark, str(path), schemas.TRANSACTIONS)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 11, 16, 23, 40, 64, 1_000])
def test_quoted_line_breaks_in_blocks_of_any_size(spark, tmp_path, size):
    """Equal to Python's reader, wherever the file is cut."""
    import csv as plain

    texts = ['id,"na\nme",c\nx,"sub\r\nheader",\n1,"a\nb ""q"" \n\n c",\n\n2,,"é, ü"\r\n3,"""",plain\n', 'id,"na\nme",c\n4,"\n",last']
    (tmp_path / "in").mkdir()
    for i, text in enumerate(texts):
        (tmp_path / "in" / f"{i}.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = csv.read_raw_csv(spark, str(tmp_path / "in"), "place")
        got = sorted(tuple(r) for r in df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = []
    for file, text in enumerate(texts):
        header, *rows = list(plain.reader(text.splitlines(keepends=True)))
        assert header == df.columns[:-1]
        want += [(*r, "" if file else str(n)) for n, r in enumerate((r for r in rows if r), 1)]
    assert got == sorted(want)
