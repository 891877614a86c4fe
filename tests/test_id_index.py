import random

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import id_index
from ebbtide.schemas import CUSTOMER_COLUMNS, CUSTOMERS
from ebbtide.streaming import ingest_stream
from test_ingest import GOOD


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "customer_id long")


def customers(spark, values):
    return spark.createDataFrame([tuple({**GOOD, "customer_id": v}[c] for c in CUSTOMER_COLUMNS) for v in values], CUSTOMERS)


def index_of(spark, parts):
    """Ranges and words of several partitions."""
    ranges, words = spark.createDataFrame([], id_index.RANGES), spark.createDataFrame([], id_index.WORDS)
    for name, values in parts.items():
        r, w = id_index.build(ids(spark, values))
        ranges = ranges.unionByName(r.withColumn(id_index.PARTITION, F.lit(name)))
        words = words.unionByName(w.withColumn(id_index.PARTITION, F.lit(name)))
    return ranges, words


def spoil(table, batch):
    """What is opened of this batch cannot be read."""
    for path in (table / f"ingest_batch={batch}").glob("*"):
        if path.suffix == ".crc" or path.name.startswith("."):
            path.unlink()
        elif path.suffix == ".parquet":
            path.write_bytes(b"no parquet")


def test_levels():
    assert [id_index.level_for(n) for n in (0, 1, 4, 5, 8, 9, 1000)] == [0, 0, 0, 1, 1, 2, 8]
    assert id_index.level_for(1 << 60) == id_index.MOST_LEVELS


def test_no_holder_is_missed_and_few_others_are_named(spark):
    draw = random.Random(5)
    parts = {f"p{i}": draw.sample(range(-50_000, 50_000), n) for i, n in enumerate((1, 7, 3000, 3000))}
    ranges, words = index_of(spark, parts)
    ranges, words = ranges.persist(), words.persist()
    for asked in ([parts["p0"][0]], parts["p1"][:2], [parts["p3"][9], None], [None], [10**15]):
        frame = ids(spark, asked).persist()
        found = set(id_index.holders(frame, ranges, words))
        assert found >= {name for name, held in parts.items() if set(held) & set(asked)}
    # an id at a time: how many of those that p2 does not hold pass its filter
    word, bits = id_index._place("customer_id", F.lit(id_index.level_for(3000)))
    strangers = ids(spark, sorted(set(range(-20_000, 20_000)) - set(parts["p2"]))).select(word.alias("word"), bits.alias("wanted"))
    passed = strangers.join(words.where("ingest_batch = 'p2'"), "word").where("(bits & wanted) = wanted").count()
    assert passed / strangers.count() < 0.02


def test_extreme_ids(spark):
    parts = {"ends": [-(1 << 63), (1 << 63) - 1], "middle": [0, 5]}
    frame = ids(spark, [-(1 << 63), 5, (1 << 63) - 1]).persist()
    assert id_index.holders(frame, *index_of(spark, parts)) == ["ends", "middle"]
    assert id_index.intervals(ids(spark, range(0, 100_000, 3))).count() <= id_index.INTERVALS


def test_a_partition_without_ids_and_an_empty_question(spark):
    ranges, words = index_of(spark, {"none": [None], "some": [1, 2]})
    assert id_index.holders(ids(spark, []).persist(), ranges, words) == []
    assert id_index.holders(ids(spark, [2]).persist(), ranges, words) == ["some"]


@pytest.fixture
def table(spark, tmp_path):
    """Three batches: old ids, newer ones, and ids between the newer ones."""
    where = tmp_path / "table"
    ingest_stream.create_table(customers(spark, range(1, 101)), str(where))
    ingest_stream.append_batch(customers(spark, range(200, 300, 2)), str(where), "even")
    ingest_stream.append_batch(customers(spark, range(201, 300, 20)), str(where), "odd")
    return where


def batch_file(folder, values):
    lines = [",".join(CUSTOMER_COLUMNS)] + [",".join(str({**GOOD, "customer_id": v}[c]) for c in CUSTOMER_COLUMNS) for v in values]
    folder.mkdir(exist_ok=True)
    path = folder / "new.csv"
    path.write_text("\n".join(lines) + "\n")
    return f"file:{path}"


def test_only_partitions_that_may_hold_an_id_are_opened(spark, table, tmp_path):
    path = batch_file(tmp_path / "in", [221, 400])  # 221 is one of "odd"
    asked = ids(spark, [221, 400]).persist()
    names = [ingest_stream.FIRST, *ingest_stream.committed(spark, str(table))]
    opened = ingest_stream.batches_for(spark, str(table), asked, names)
    assert "odd" in opened and ingest_stream.FIRST not in opened
    for name in set(names) - set(opened):
        spoil(table, name)
    logged = ingest_stream.ingest_files(spark, [path], str(table), str(tmp_path / "log"), "b1").first()
    assert (logged["status"], logged["unique_rows"], logged["written_rows"]) == ("ingested", 2, 1)
    written = spark.read.schema(CUSTOMERS).parquet(f"{table}/ingest_batch=b1")
    assert [r["customer_id"] for r in written.collect()] == [400]


def test_ids_above_all_others_open_nothing(spark, table, tmp_path):
    path = batch_file(tmp_path / "in", [1000, 1001])
    for name in (ingest_stream.FIRST, "even", "odd"):
        spoil(table, name)
    assert ingest_stream.ingest_files(spark, [path], str(table), str(tmp_path / "log"), "b1").first()["written_rows"] == 2


def test_a_partition_without_an_index_is_opened(spark, table):
    customers(spark, [7000]).write.parquet(f"{table}/ingest_batch=older")
    (table / "_committed" / "older").touch()
    asked = ids(spark, [7000]).persist()
    known = ingest_stream.rows_for(spark, str(table), ["older", "even"])(asked)
    assert [r["customer_id"] for r in known.collect()] == [7000]


@pytest.mark.parametrize("mode", ["reject_file", "drop_rows"])
def test_the_index_changes_no_result(spark, table, tmp_path, mode):
    draw = random.Random(3)
    path = batch_file(tmp_path / "in", draw.sample(range(1, 600), 120))
    before = ingest_stream.read_table(spark, str(table)).select("customer_id").collect()
    rows, _ = ingest_stream.read_files(spark, [path])
    plain = ingest_stream.ingest_batch(rows, ids(spark, [r[0] for r in before]), mode)
    expected = sorted(r["customer_id"] for r in plain.rows.collect())
    ingest_stream.ingest_files(spark, [path], str(table), str(tmp_path / "log"), "b1", mode)
    written = spark.read.schema(CUSTOMERS).parquet(f"{table}/ingest_batch=b1")
    assert sorted(r["customer_id"] for r in written.collect()) == expected
