"""Encryption, masking, watermarks, profiles, files and fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.durable import checkpoint_folder, settle
from tidemark.operators import fixtures, profile, protection, watermark
from tidemark.operators.compare import assert_empty, assert_same_rows
from tidemark.sources.files import load_files
from tidemark.spec import TableSpec

NOW = dt.datetime(2024, 6, 1, 12)


@pytest.fixture()
def keys():
    return protection.GrantedKeys({"BirthdatePII": b"0123456789abcdef"}, {"BirthdatePII": ["Owner"]})


@pytest.fixture()
def employees(spark):
    rows = [(1, "Luke", dt.datetime(1951, 9, 25)), (2, "Ben", None)]
    return spark.createDataFrame(rows, "EmployeeID INT, FirstName STRING, BirthDate TIMESTAMP_NTZ")


def test_encryption_round_trip(spark, keys, employees):
    key = keys.open("BirthdatePII", "owner")
    table = protection.encrypt(employees, "BirthDate", "Cipher", key)
    new = spark.createDataFrame([(6, "Han", dt.datetime(1948, 4, 12))], employees.schema)
    table = protection.insert_encrypted(table, new, {"BirthDate": "Cipher"}, key)
    assert isinstance(table.schema["Cipher"].dataType, T.BinaryType)
    rows = protection.decrypt(table, "Cipher", "Plain", "timestamp_ntz", key).collect()
    assert len(rows) == 3 and all(r["Plain"] == r["BirthDate"] for r in rows)
    assert all((r["Cipher"] is None) == (r["BirthDate"] is None) for r in rows)
    closed = protection.decrypt(table, "Cipher", "Plain", "timestamp_ntz", None).collect()
    assert [r["Plain"] for r in closed] == [None] * 3
    wrong = protection.OpenKey("x", b"fedcba9876543210")
    assert [r["Plain"] for r in protection.decrypt(table, "Cipher", "Plain", "timestamp_ntz", wrong).collect()] == [None] * 3


def test_equal_values_encrypt_apart(spark, keys):
    key = keys.open("BirthdatePII", "Owner")
    same = spark.range(20).select(F.when(F.col("id") >= 0, "same").alias("v"))
    assert protection.encrypt(same, "v", "c", key).select("c").distinct().count() == 20


def test_right_to_open_a_key(keys):
    for key_id, user in (("BirthdatePII", "TestBirthDate"), ("Other", "Owner")):
        with pytest.raises(protection.KeyAccessError):
            keys.open(key_id, user)
    keys.grants["BirthdatePII"].append("TestBirthDate")
    assert keys.open("BirthdatePII", "testbirthdate").secret
    keys.available = False
    with pytest.raises(protection.KeyAccessError):
        keys.open("BirthdatePII", "Owner")


def test_keys_stay_out_of_texts(spark, keys, employees):
    key = keys.open("BirthdatePII", "Owner")
    assert "0123456789abcdef" not in repr(key) + repr(keys)
    spark.conf.set("spark.sql.redaction.string.regex", protection.REDACT_KEYS)
    try:
        table = protection.encrypt(employees, "BirthDate", "Cipher", key)
        plain = protection.decrypt(table, "Cipher", "Plain", "timestamp_ntz", key)
        plan = "".join(spark._jvm.PythonSQLUtils.explainString(plain._jdf.queryExecution(), m) for m in ("extended", "formatted"))
        assert "aes" in plan.lower()
        for form in ("0123456789abcdef", b"0123456789abcdef".hex(), b"0123456789abcdef".hex().upper()):
            assert form not in plan
    finally:
        spark.conf.unset("spark.sql.redaction.string.regex")


def test_masks(spark):
    df = spark.sql(
        "SELECT 'Bank 12' AS s, 5 AS i, 2.5 AS d, true AS b, DATE'2020-02-02' AS t, X'FF' AS x, CAST(NULL AS STRING) AS n"
    )
    row = protection.mask_columns(df, df.columns).first()
    assert (row["s"], row["i"], float(row["d"]), row["b"], row["t"], bytes(row["x"]), row["n"]) == (
        "XXXX", 0, 0.0, False, dt.date(1900, 1, 1), b"\x00", None,
    )
    with pytest.raises(ValueError):
        protection.mask_columns(df, ["absent"])


def test_watermark_columns(spark):
    rows = [
        ("A", "T1", "LastModified"), ("A", "T1", "Created"), ("A", "T2", "Created"), ("A", "T2", "LogDate"),
        ("B", "T1", "Created"), ("A", "T3", "x"), ("zExceptionA", "T4", "LastModified"), ("A", "T5", "LASTCHANGE"),
    ]
    columns = spark.createDataFrame(rows, "schemaname STRING, tablename STRING, columnname STRING")
    found = [tuple(r) for r in watermark.watermark_columns(columns).collect()]
    # B.T1 gets none: another schema's T1 has a "modified" column.
    assert found == [("A", "T1", "LastModified"), ("A", "T2", "Created"), ("A", "T2", "LogDate"), ("A", "T5", "LASTCHANGE")]
    full = [tuple(r) for r in watermark.watermark_columns(columns, default=watermark.FULL_LOAD_COLUMN).collect()]
    assert set(full) - set(found) == {("A", "T3", "DWLoadDate"), ("B", "T1", "DWLoadDate")}


def test_empty_and_null_tables_change_nothing(spark):
    filled = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01' AS t UNION ALL SELECT NULL")
    tables = {("s", "a"): filled, ("s", "b"): filled.where("t IS NULL"), ("s", "c"): filled.where("false")}
    values = watermark.max_watermarks(tables, [("s", n, "t") for n in "abc"]).collect()
    assert [(r["tablename"], r["watermark"]) for r in values] == [("a", dt.datetime(2024, 1, 1))]


def test_update_watermarks(spark):
    control = spark.sql("SELECT * FROM VALUES (1, 1, TIMESTAMP_NTZ'2020-01-01'), (1, 2, NULL), (2, 1, NULL) AS t(TaskID, DatabaseID, LoadWatermark)")
    tasks = spark.sql("SELECT * FROM VALUES (1, 'load'), (2, 'other') AS t(TaskID, TaskName)")
    instances = spark.sql("SELECT * FROM VALUES (1, 'db', 'north'), (2, 'db', 'south') AS t(DatabaseID, DatabaseName, InstanceName)")
    databases = spark.sql("SELECT 'db' AS DatabaseName")
    args = (control, tasks, instances, databases, "load", "south", "db")
    updated = {(r[0], r[1]): r[2] for r in watermark.update_watermarks(*args, NOW).collect()}
    assert updated == {(1, 1): dt.datetime(2020, 1, 1), (1, 2): NOW, (2, 1): None}
    assert_same_rows(control, watermark.update_watermarks(*args, None))
    assert_same_rows(control, watermark.update_watermarks(*args[:3], databases.where("false"), *args[4:], NOW))


def test_slices(spark):
    df = spark.sql("SELECT explode(array(DATE'2018-05-31', DATE'2018-06-01', NULL)) AS d")
    assert [r["d"] for r in watermark.since(df, "d", "2018-06-01").collect()] == [dt.date(2018, 6, 1)]
    control = [("s", "a", "d"), ("s", "a", "e"), ("s", "b", None)]
    both = df.withColumn("e", F.lit("2019-01-01").cast("date"))
    slices = watermark.incremental_slices({("s", "a"): both, ("s", "b"): df}, control, "2018-06-01")
    assert {name: part.count() for name, part in slices.items()} == {("s", "a", "d"): 1, ("s", "a", "e"): 3}
    assert watermark.new_rows(both, ["d", "e"], "2018-06-01").count() == 3
    with pytest.raises(LookupError, match="unknown"):
        watermark.incremental_slices({("s", "a"): both}, [*control, ("s", "unknown", "d")], "2018-06-01")


def test_profiles(spark):
    small, large = spark.range(2), spark.range(5).withColumn("t", F.lit("2018-01-01").cast("timestamp_ntz"))
    counts = profile.table_counts({"small": small, "large": large, "also": small}).collect()
    assert [(r[0], r[1]) for r in counts] == [("large", 5), ("also", 2), ("small", 2)]
    assert [tuple(r) for r in profile.table_columns({"large": large}).collect()] == [
        ("large", 1, "id", "bigint"), ("large", 2, "t", "timestamp_ntz"),
    ]
    newer = large.withColumn("t", F.lit("2018-02-05").cast("timestamp_ntz"))
    stale = profile.stale_tables({"b": (large, "t"), "a": (large, "t"), "c": (newer, "t")}, "20180205"[:4] + "-02-05")
    assert [r["table_name"] for r in stale.collect()] == ["a", "b"]
    assert profile.copy_columns(large, ["id"]).columns == ["id"]
    assert profile.copy_columns(large, {"id": "key"}).columns == ["key"]


def test_files(spark, tmp_path):
    (tmp_path / "log.txt").write_bytes(b"a\nb\x00")
    (tmp_path / "other.bin").write_bytes(bytes(range(256)))
    rows = {r["name"]: bytes(r["content"]) for r in load_files(spark, str(tmp_path)).collect()}
    assert rows == {"log.txt": b"a\nb\x00", "other.bin": bytes(range(256))}
    assert [r["length"] for r in load_files(spark, str(tmp_path), "*.txt").collect()] == [4]


def test_files_longer_than_a_blob(spark, tmp_path, monkeypatch):
    """Files of a length with and without divisors come in pieces, whole and in order; so do their marks."""
    from tidemark.plans import governance

    sizes = {"even.parquet": 4096, "prime.parquet": 4099, "a,b[1] {c}.parquet": 6006, "short.parquet": 90, "cut.parquet.gz": 3000}
    written = {}
    for number, (name, size) in enumerate(sizes.items()):
        middle = random.Random(number).randbytes(size - 8)
        written[name] = b"PAR1" + middle + b"1RAP"
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_bytes(written[name])
    got = {}
    for row in load_files(spark, str(tmp_path), recursive=True, piece=1000).orderBy("path", "position").collect():
        assert len(row["content"]) <= 1000 or row["name"].endswith(".gz")
        assert row["position"] == len(got.get(row["name"], b""))
        assert row["length"] == sizes[row["name"]]
        got[row["name"]] = got.get(row["name"], b"") + bytes(row["content"])
    assert got == written
    monkeypatch.setattr(governance, "PIECE", 1000, raising=False)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        rows = {tuple(r) for r in governance.QUERIES["files_as_rows"].run(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert rows == {(name, "PAR1", "1RAP", True) for name in sizes if name.endswith(".parquet")}


ALL_TYPES = (
    T.StructType()
    .add("id", T.IntegerType()).add("small", T.ShortType()).add("text", T.StringType()).add("flag", T.BooleanType())
    .add("money", T.DecimalType(19, 4)).add("real", T.FloatType()).add("day", T.DateType()).add("at", T.TimestampNTZType())
    .add("zoned", T.TimestampType()).add("blob", T.BinaryType()).add("Deleted", T.BooleanType())
    .add("ServerExecutionID", T.LongType()).add("tree", T.ArrayType(T.LongType()))
    .add("guid", T.StringType(), True, {"guid": True})
)


def test_fixture_values(spark):
    rows = fixtures.fixture_rows(spark, ALL_TYPES, 3, NOW)
    assert rows.schema.fieldNames() == ALL_TYPES.fieldNames() and rows.count() == 3
    assert [f.dataType for f in rows.schema] == [f.dataType for f in ALL_TYPES]
    row = rows.first()
    assert (row["id"], row["small"], row["text"], row["flag"], float(row["money"]), row["real"]) == (1, 1, "A", True, 1.0, 1.0)
    assert (row["day"], row["at"], bytes(row["blob"])) == (NOW.date(), NOW, b"\x01")
    assert (row["Deleted"], row["ServerExecutionID"], row["tree"], row["guid"]) == (False, 0, None, fixtures.BASE_GUID)


@pytest.mark.parametrize("column, value", [("text", "B"), ("small", 2), ("flag", False), ("at", NOW + dt.timedelta(days=1))])
def test_perturbation_by_type(spark, column, value):
    first = ["id", column, *(n for n in ALL_TYPES.fieldNames() if n not in ("id", column))]
    rows = fixtures.fixture_rows(spark, ALL_TYPES, 1, NOW).select(*first)
    changed = fixtures.perturb(rows, TableSpec(keys=("id",)), NOW)
    assert changed.first()[column] == value
    assert_same_rows(rows.drop(column), changed.drop(column))


def test_binary_and_deleted_are_never_changed(spark):
    spec = TableSpec(keys=("id",))
    rows = fixtures.fixture_rows(spark, ALL_TYPES, 1, NOW)
    binary = rows.select("id", "blob")
    assert_same_rows(binary, fixtures.perturb(binary, spec, NOW))
    assert_same_rows(rows, fixtures.perturb(rows, spec, NOW, versioned=False))
    with pytest.raises(ValueError):
        fixtures.perturb(rows.select("id"), spec, NOW)


def test_check_view(spark):
    sources = {"a": T.StructType().add("id", T.IntegerType()).add("x", T.StringType()), "b": T.StructType().add("id", T.IntegerType()).add("y", T.DoubleType())}
    fixtures.check_view(lambda t: t["a"].join(t["b"], "id"), sources, spark, NOW)
    with pytest.raises(AssertionError):
        fixtures.check_view(lambda t: t["a"].join(t["b"], "id").withColumn("y", F.lit(None).cast("double")), sources, spark, NOW)


def test_sample_data_repeats_and_fits_its_users(spark):
    users = fixtures.sample_users(spark)
    assert users.count() == 50 and users.orderBy("UserID").first()["Username"] == "User1"
    data = fixtures.sample_data(spark, 1000, seed=5)
    assert_same_rows(data, fixtures.sample_data(spark, 1000, seed=5))
    assert_empty(data.join(users, "UserID", "left_anti"))
    low, high = data.agg(F.min("RowKey"), F.max("RowKey")).first()
    assert (low, high, data.count()) == (1, 1000, 1000)


def test_settle_keeps_rows_and_schema(spark):
    df = spark.range(5).withColumn("a", F.array("id"))
    settled = settle(df)
    assert_same_rows(df, settled)
    assert settled.dtypes == df.dtypes
    assert checkpoint_folder(spark) in settled.inputFiles()[0]


def test_named_checkpoint_folder_is_used(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: str(tmp_path) + "/")
    assert checkpoint_folder(spark) == str(tmp_path)


def test_sample_data_does_not_hang_on_partitions(spark):
    rows = fixtures.sample_data(spark, 500, seed=3)
    again = fixtures.sample_data(spark, 500, seed=3).repartition(7)
    assert_same_rows(rows, again)
    values = {r["IntColumn"] for r in rows.collect()}
    assert len(values) > 480 and 0 <= min(values) and max(values) <= 100_000
    assert {r["UserID"] for r in rows.collect()} <= set(range(1, 51))


def test_an_instant_reads_the_same_in_every_zone(spark, keys):
    key = keys.open("BirthdatePII", "Owner")
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql("SELECT timestamp_micros(1577880000123456) AS t, X'00FF' AS b, CAST(NULL AS TIMESTAMP) AS n")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        rows = df
        for c in ("t", "b", "n"):
            rows = protection.encrypt(rows, c, f"{c}_cipher", key)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        plain = protection.decrypt(rows, "t_cipher", "t_plain", "timestamp", key)
        plain = protection.decrypt(plain, "b_cipher", "b_plain", "binary", key)
        plain = protection.decrypt(plain, "n_cipher", "n_plain", "timestamp", key)
        row = plain.select(F.unix_micros("t_plain").alias("t"), "b_plain", "n_plain").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["t"], bytes(row["b_plain"]), row["n_plain"]) == (1577880000123456, b"\x00\xff", None)
    with pytest.raises(TypeError):
        protection.encrypt(spark.sql("SELECT array(1) AS a"), "a", "c", key)
