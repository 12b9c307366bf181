"""Files, schema checks, made-up lines and the shared tables."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillroll import staging
from tillroll.catalog import tables
from tillroll.catalog.queries import QUERIES
from tillroll.schema import COLUMNS, TRANSACTIONS, validate_schema
from tillroll.session import shared_dir
from tillroll.sources import files
from tillroll.sources.synthetic import synthetic_transactions
from tillroll.sources.warehouse import TABLES, transactions

SMALL = "/root/testdata/sf0.001"


def test_csv_in_latin1_with_spaced_customer_column(spark, tmp_path):
    path = tmp_path / "online.csv"
    text = (
        "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
        '489434,85123A,"CAF\xc9, SET",6,2009-12-01 07:45:00,2.55,013085,United Kingdom\n'
        "C489435,22632,,-1,2009-12-01 07:46:00,1.85,,France\n"
    )
    path.write_bytes(text.encode("latin-1"))
    rows = files.load_transactions(spark, str(path), encoding="ISO-8859-1").orderBy("Invoice").collect()
    assert files.load_transactions(spark, str(path)).schema == TRANSACTIONS
    assert (rows[0]["Description"], rows[0]["CustomerID"], rows[0]["Quantity"]) == ("CAF\xc9, SET", "013085", 6)
    assert (rows[1]["CustomerID"], rows[1]["Description"], float(rows[1]["Price"])) == (None, None, 1.85)


def test_missing_and_unknown_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_transactions(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        files.load_transactions(spark, str(tmp_path / "book.xlsx"))


def test_csv_without_a_needed_column(spark, tmp_path):
    (tmp_path / "short.csv").write_text("Invoice,Price\n1,2.5\n")
    with pytest.raises(ValueError, match="missing columns"):
        files.load_transactions(spark, str(tmp_path / "short.csv"))


def test_parquet_round_trip(spark, lines, tmp_path):
    tx = lines(("1", "A", 2, "2011-01-01 10:00:00", 5.25, "7"), ("2", "A", 2, "2011-01-01", 5, None))
    files.save_table(tx, str(tmp_path / "lines.parquet"))
    back = files.load_transactions(spark, str(tmp_path / "lines.parquet"))
    assert back.exceptAll(tx).count() == 0 and back.count() == 2


def test_schema_check_accepts_the_alias(lines):
    tx = lines(("1", "A", 2, "2011-01-01", 5, "7"))
    renamed, valid = validate_schema(tx.withColumnRenamed("CustomerID", "Customer ID"))
    assert valid and "CustomerID" in renamed.columns
    assert not validate_schema(tx.drop("Price"))[1]


@pytest.mark.parametrize("columns", [["StockCode"], ["Price", "Quantity"], ["CustomerID"], ["Country", "Invoice"], COLUMNS])
def test_joining_fewer_tables_never_changes_the_rows(spark, columns):
    whole = transactions(spark, SMALL).select(*columns)
    part = transactions(spark, SMALL, columns)
    assert part.columns == [c for c in COLUMNS if c in columns]
    assert part.select(*columns).exceptAll(whole).count() == 0
    assert part.count() == whole.count()


def test_only_needed_tables_are_read(spark):
    plan = transactions(spark, SMALL, ["StockCode", "Price"])._jdf.queryExecution().optimizedPlan().toString()
    assert "p_retailprice" in plan and "o_orderkey" not in plan and "n_name" not in plan


@pytest.fixture
def repeated(spark, tmp_path):
    """Lines stored twice, some once more with other cents of a quantity, without flags, of no part or of no order."""
    for table in ("orders", "customer", "nation", "part"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    some = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    third = some.where("l_orderkey % 3 = 0")
    odd = [
        third,
        third.withColumn("l_quantity", F.col("l_quantity") + 0.4).withColumn("l_linenumber", F.lit(99)),
        third.withColumn("l_returnflag", F.lit(None).cast("string")),
        third.limit(50).withColumn("l_partkey", F.lit(None).cast("bigint")),
        third.limit(50).withColumn("l_orderkey", F.lit(None).cast("bigint")),
        third.limit(50).withColumn("l_orderkey", F.lit(10**12)),
        third.limit(50).withColumn("l_partkey", F.lit(101)),
        third.limit(50).withColumn("l_partkey", F.lit(102)),
    ]
    for more in odd:
        some = some.unionByName(more)
    some.write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_sold_lines_are_the_cleaned_lines_without_descriptions(spark, repeated):
    want, got = tables.cleaned(spark, repeated), tables.sold(spark, repeated)
    assert got.columns == [c for c in want.columns if c != "Description"]
    want = want.select(*got.columns)
    assert got.count() == want.count() > 1000
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_features_and_segments_carry_no_descriptions(spark, tmp_path):
    """What the feature table and the segments stage and shuffle grows with narrow lines alone."""
    for table in TABLES:
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    tables.feature_table(spark, str(tmp_path))
    tables.segments(spark, str(tmp_path))
    staged = {key[2]: entry[2].fieldNames() for key, entry in staging._stages.items() if key[1] == str(tmp_path)}
    assert {"features", "segments"} < set(staged)
    assert not any("Description" in columns for columns in staged.values())
    lines = transactions(spark, SMALL, [c for c in COLUMNS if c != "Description"], cancelled=False, distinct=True)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "Description" not in plan
    assert plan.index("Aggregate [l_orderkey") > plan.index("Join LeftOuter, (l_orderkey")


def test_lines_are_grouped_once_and_as_numbers(spark, monkeypatch):
    """The one step that holds all lines of a task in a hash table holds four numbers of each; whole lines spilled at 60 times sf0.1."""
    built = {}
    monkeypatch.setattr(tables, "stage", lambda spark, folder, label, build: built.setdefault(label, build()))
    tables.sold(spark, SMALL)
    plan = built["sold"]._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Aggregate \[(.*?)\], \[", plan)
    assert [re.sub(r"#\d+L?", "", k) for k in keys] == ["l_orderkey, l_partkey, returned, quantity"]


def test_synthetic_lines_are_the_same_on_any_partitioning(spark):
    once = synthetic_transactions(spark, 2000)
    assert once.schema.simpleString() == TRANSACTIONS.simpleString()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        again = synthetic_transactions(spark, 2000)
        assert once.exceptAll(again).count() == 0
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    facts = once.agg(
        F.avg(F.startswith("Invoice", F.lit("C")).cast("int")).alias("cancelled"),
        F.avg(F.col("CustomerID").isNull().cast("int")).alias("guests"),
        F.countDistinct("StockCode").alias("products"),
        F.countDistinct(F.regexp_replace("Invoice", "^C", "")).alias("invoices"),
    ).first()
    assert facts["cancelled"] == pytest.approx(0.05, abs=0.02)
    assert facts["guests"] == pytest.approx(0.2, abs=0.03)
    assert facts["products"] == 5
    assert facts["invoices"] == pytest.approx(400, abs=60)


def test_stage_is_built_once_and_again_after_discard(spark, tmp_path):
    built = []
    spark.range(7).write.parquet(str(tmp_path / "in"))

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert staging.stage(spark, str(tmp_path / "in"), "probe", build).count() == 3
    assert len(built) == 1
    staging.discard(spark)
    assert staging.stage(spark, str(tmp_path / "in"), "probe", build).count() == 3
    assert len(built) == 2


def test_stage_follows_its_input(spark, tmp_path):
    path = str(tmp_path / "in")
    build = lambda: spark.read.parquet(path)
    for rows in (7, 9, 9):
        spark.range(rows).write.mode("overwrite").parquet(path)
        assert staging.stage(spark, path, "follow", build).count() == rows


def test_partitions_of_a_stage_grow_with_its_input(spark, tmp_path, monkeypatch):
    """Few partitions for the session's other jobs do not make the tasks of a stage grow: those spilled at 180 times sf0.1."""
    path, size = str(tmp_path / "in"), 1 << 15
    spark.range(100_000).selectExpr("xxhash64(id) AS id").coalesce(1).write.parquet(path)
    monkeypatch.setattr(staging, "SHARE", size)
    keys = ("spark.sql.shuffle.partitions", staging._FIRST, *staging._LARGEST)
    before = {k: spark.conf.get(k, None) for k in keys}
    seen = {}

    def build():
        rows = spark.read.parquet(path)
        seen["scan"] = rows.rdd.getNumPartitions()
        seen.update((k, spark.conf.get(k, None)) for k in keys)
        return staging.written(rows.distinct(), "inner").groupBy("id").count()

    stored = staging.identity(spark, path)[1]
    least = stored // size
    assert least > 3 * int(before[keys[0]])
    staged = staging.stage(spark, path, "spread", build)
    assert seen["scan"] >= least and int(seen[keys[0]]) >= least
    assert [seen[k] for k in staging._LARGEST] == [str(size)] * 2
    files = staged.select(F.input_file_name().alias("f")).distinct().count()
    assert files >= least  # the fixture's session does not put small partitions together
    assert staged.count() == 100_000
    assert {k: spark.conf.get(k, None) for k in keys} == before

    def fails():
        raise ValueError("no table")

    with pytest.raises(ValueError, match="no table"):
        staging.stage(spark, path, "fails", fails)
    assert {k: spark.conf.get(k, None) for k in keys} == before


@pytest.mark.parametrize("name", ["feature_table", "join_features", "join_rfm_behaviour"])
def test_feature_tables_are_built_in_partitions_of_their_size(spark, name, monkeypatch, tmp_path):
    for table in TABLES:
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    monkeypatch.setattr(staging, "SHARE", 10_000)
    table = QUERIES[name](spark, str(tmp_path))
    assert table.select(F.input_file_name().alias("f")).distinct().count() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = QUERIES[name](spark, SMALL)
    assert table.exceptAll(want).count() == want.exceptAll(table).count() == 0


def test_spread_keeps_settings_for_smaller_tasks(spark):
    keys = dict.fromkeys(staging._LARGEST, "1m") | {"spark.sql.shuffle.partitions": "211"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        with staging.spread(spark, 50 * staging.SHARE):
            assert {k: spark.conf.get(k) for k in keys} == keys
            with staging.spread(spark, 300 * staging.SHARE):
                assert spark.conf.get("spark.sql.shuffle.partitions") == "300"
            assert spark.conf.get("spark.sql.shuffle.partitions") == "211"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    with staging.spread(spark, staging.SHARE):
        assert {k: spark.conf.get(k, None) for k in keys} == before


@pytest.mark.parametrize("text, size", [("134217728b", 1 << 27), ("1m", 1 << 20), ("64MB", 1 << 26), ("300", 300), ("2kb", 2048)])
def test_sizes_of_settings(text, size):
    assert staging._bytes(text) == size


def test_scratch_deletes_what_was_written(spark):
    with staging.scratch(spark):
        path = staging.fresh_path(spark, "gone")
        spark.range(2).write.parquet(path)
        assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    else:
        assert shared_dir(spark)


DATES = {
    "2009-12-01": datetime(2009, 12, 1), "2009-12-01 07:45": datetime(2009, 12, 1, 7, 45), "12/1/2010 8:26": datetime(2010, 12, 1, 8, 26),
    "2009-12-01 07:45:01": datetime(2009, 12, 1, 7, 45, 1), "2009-12-01T07:45:01": datetime(2009, 12, 1, 7, 45, 1),
    "2009-12-01 07:45:01.5": datetime(2009, 12, 1, 7, 45, 1, 500000), "1/31/2011": datetime(2011, 1, 31), "": None,
}


def test_csv_dates_numbers_and_quotes(spark, tmp_path):
    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    rows = [f'{n},1,"SET ""15"", LAMP",6.0,{d},2.50,13085.0,X' for n, d in enumerate(DATES)]
    (tmp_path / "shop.csv").write_text(head + "\n".join(rows) + "\n")
    got = {int(r.Invoice): r for r in files.load_transactions(spark, str(tmp_path / "shop.csv")).collect()}
    assert [got[n].InvoiceDate for n in range(len(DATES))] == list(DATES.values())
    assert {(r.Description, r.Quantity, r.CustomerID) for r in got.values()} == {('SET "15", LAMP', 6, "13085.0")}


@pytest.mark.parametrize("column, text", [("Quantity", "6.5"), ("InvoiceDate", "yesterday"), ("Price", "dear")])
def test_csv_with_a_wrong_value_raises(spark, tmp_path, column, text):
    row = {"Invoice": "1", "StockCode": "1", "Description": "x", "Quantity": "1", "InvoiceDate": "2009-12-01", "Price": "1", "CustomerID": "1", "Country": "X"}
    row[column] = text
    (tmp_path / "wrong.csv").write_text(",".join(row) + "\n" + ",".join(row.values()) + "\n")
    with pytest.raises(Exception):
        files.load_transactions(spark, str(tmp_path / "wrong.csv")).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_round_trip_keeps_every_text(spark, lines, tmp_path, multi_line):
    texts = ["  PAD  ", "", None, 'a "b", c', '"', ",", "\u65e5\u672c", "\u20ac", "\\", "\\N", "null"] + (["two\nlines"] if multi_line else [])
    tx = lines(*[(str(n), "1", 1, "2010-01-01 00:00:00", "1.00", "1", "X", t) for n, t in enumerate(texts)])
    files.save_csv(tx, str(tmp_path / "out"))
    back = files.load_transactions(spark, str(tmp_path / "out"), format="csv", multi_line=multi_line)
    assert {int(r.Invoice): r.Description for r in back.collect()} == dict(enumerate(texts))
    with pytest.raises(ValueError, match="csv and parquet"):
        files.load_transactions(spark, str(tmp_path / "out"))


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def test_files_of_mixed_encodings_and_bad_rows(spark, tmp_path):
    def put(name, encoding, *rows):
        (tmp_path / name).write_bytes("\n".join([HEADER, *rows, ""]).encode(encoding))

    put("a.csv", "utf-8", "1,A,CAF\u00c9 \u20ac \u65e5,1,2011-01-02 03:04:05,2.50,7,France", '2,B,"SAYS ""HI"", OK",2.0,1/2/2011 3:04,3,,France')
    put("b.csv", "latin-1", "3,C,CAF\u00c9,3,2011-01-02,4,9.0,\u00c5land", "4,D,BAD PRICE,1,2011-01-02,x,1,\u00c5land", "5,E,BAD DATE,1,2011-13-45,1,1,Spain")
    put("c.csv", "utf-8", "6,F,TOO FEW,1", "7,G,,,,,,", "8,H,MANY,1,2011-01-02,1,1,Spain,EXTRA", "9,I,HALF,1.5,2011-01-02,1,1,Spain")
    lines, bad = files.load_mixed(spark, str(tmp_path))
    got = {r.Invoice: r for r in lines.collect()}
    assert set(got) == {"1", "2", "3", "7"} and lines.schema == TRANSACTIONS
    assert (got["1"].Description, got["3"].Description, got["3"].Country) == ("CAF\u00c9 \u20ac \u65e5", "CAF\u00c9", "\u00c5land")
    assert (got["2"].Description, got["2"].Quantity, got["2"].InvoiceDate.isoformat()) == ('SAYS "HI", OK', 2, "2011-01-02T03:04:00")
    assert got["7"].Price is None and got["7"].InvoiceDate is None
    found = sorted((r.file.rsplit("/", 1)[1], r.reason, r.row.split(",")[0]) for r in bad.collect())
    assert found == [
        ("b.csv", "InvoiceDate", "5"), ("b.csv", "Price", "4"), ("c.csv", "Quantity", "9"), ("c.csv", "number of values", "6"),
        ("c.csv", "number of values", "8"),
    ]
    whole, none = files.load_mixed(spark, str(tmp_path / "a.csv"))
    assert whole.count() == 2 and none.count() == 0
