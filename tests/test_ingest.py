from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ebbtide.operators import ingest
from ebbtide.schemas import CUSTOMER_COLUMNS, CUSTOMERS
from ebbtide.sources import batches
from ebbtide.streaming import ingest_stream

GOOD = dict(
    customer_id=1, credit_score=600.0, geography="Delhi", gender="Male", age=40, tenure=3, balance=10.0,
    num_products=1, has_credit_card=1, is_active_member=1, estimated_salary=20.0, exited=0,
)
NAMES = ["file_name", "rn", *CUSTOMER_COLUMNS]
SCHEMA = "file_name string, rn long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CUSTOMERS)


def incoming(spark, *rows):
    made = []
    for i, (file_name, change) in enumerate(rows):
        row = {"file_name": file_name, "rn": i} | GOOD | change
        made.append(tuple(row[n] for n in NAMES))
    return spark.createDataFrame(made, SCHEMA)


def existing(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "customer_id long")


def decide(spark, rows, known=(), mode=ingest.REJECT_FILE):
    result = ingest.ingest_batch(incoming(spark, *rows), existing(spark, *known), mode)
    status = {r["file_name"]: r["status"] for r in result.files.collect()}
    return status, sorted((r["file_name"], r["customer_id"]) for r in result.rows.collect()), result


def test_order_of_steps_inside_a_file(spark):
    # the first occurrence is out of range, so its id is gone although a later row is valid
    status, rows, result = decide(
        spark, [("a", dict(customer_id=5, age=10)), ("a", dict(customer_id=5)), ("a", dict(customer_id=6)), ("a", dict(customer_id=7))], [7]
    )
    assert status == {"a": "ingested"} and rows == [("a", 6)]
    counts = result.files.first()
    assert (counts["unique_rows"], counts["new_rows"], counts["out_of_range_rows"], counts["written_rows"]) == (3, 2, 1, 1)


def test_null_is_not_valid_on_ingest(spark):
    status, rows, _ = decide(spark, [("a", dict(customer_id=5, balance=None)), ("a", dict(customer_id=6))])
    assert rows == [("a", 6)]


def test_a_violation_rejects_the_file_but_null_passes(spark):
    status, rows, _ = decide(
        spark,
        [("a", dict(customer_id=1)), ("a", dict(customer_id=2, geography="France")), ("b", dict(customer_id=3, gender=None))],
    )
    assert status == {"a": "check_violation", "b": "ingested"} and rows == [("b", 3)]


def test_a_violation_outside_the_ranges_is_not_written_and_does_not_count(spark):
    status, rows, _ = decide(spark, [("a", dict(customer_id=1)), ("a", dict(customer_id=2, geography="France", age=5))])
    assert status == {"a": "ingested"} and rows == [("a", 1)]


def test_a_chain_of_shared_ids(spark):
    # b clashes with a; c shares ids with b only, which is not written
    rows = [("a", dict(customer_id=1)), ("b", dict(customer_id=1)), ("b", dict(customer_id=2)), ("c", dict(customer_id=2)), ("d", dict(customer_id=9))]
    status, taken, _ = decide(spark, rows)
    assert status == {"a": "ingested", "b": "duplicate_ids", "c": "ingested", "d": "ingested"}
    assert taken == [("a", 1), ("c", 2), ("d", 9)]
    status, taken, _ = decide(spark, rows, mode=ingest.DROP_ROWS)
    assert set(status.values()) == {"ingested"} and taken == [("a", 1), ("b", 2), ("d", 9)]


def one_by_one(rows):
    """Files in the order of their names against the ids written so far."""
    status, taken, written = {}, [], set()
    for name in sorted({f for f, _ in rows}):
        ids = list(dict.fromkeys(i for f, i in rows if f == name))
        if written & set(ids):
            status[name] = "duplicate_ids"
        else:
            status[name] = "ingested"
            written |= set(ids)
            taken += [(name, i) for i in ids]
    return status, sorted(taken)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 12)), min_size=1, max_size=25))
def test_rounds_agree_with_one_file_at_a_time(spark, rows):
    status, taken, _ = decide(spark, [(f, dict(customer_id=i)) for f, i in rows])
    assert (status, taken) == one_by_one(rows)


def test_summary_has_a_total(spark):
    _, _, result = decide(spark, [("a", dict(customer_id=1)), ("b", dict(customer_id=2, age=1))])
    rows = {r["file_name"]: r for r in ingest.ingest_summary(result.files).collect()}
    assert rows["TOTAL"]["written_rows"] == 1 and rows["TOTAL"]["out_of_range_rows"] == 1
    assert rows["b"]["status"] == "no_new_rows"


def test_headers():
    raw = ["EXITED", "CustomerId", "creditscore", "Geography", "gender", "Age", "Tenure", "balance", "NumOfProducts",
           "HasCrCard", "is_active_member", "EstimatedSalary", "note"]
    assert batches.map_header(raw)["exited"] == "EXITED"
    with pytest.raises(batches.HeaderError, match="missing columns: exited"):
        batches.map_header(raw[1:])
    with pytest.raises(batches.HeaderError, match="two columns for customer_id"):
        batches.map_header([*raw, "customer_id"])
    with pytest.raises(ValueError, match="tenure"):
        batches.require_columns(["age"], ["age", "tenure"])


HEADER = "CustomerId,CreditScore,Geography,Gender,Age,Tenure,Balance,NumOfProducts,HasCrCard,IsActiveMember,EstimatedSalary,Exited"


def line(i, **change):
    row = dict(GOOD) | {"customer_id": i} | change
    return ",".join(str(row[c]) for c in CUSTOMER_COLUMNS)


@pytest.fixture
def place(spark, tmp_path):
    folder, table, log = tmp_path / "in coming+1", str(tmp_path / "table"), str(tmp_path / "log")
    folder.mkdir()
    ingest_stream.create_table(spark.createDataFrame([tuple({**GOOD, "customer_id": 7}[c] for c in CUSTOMER_COLUMNS)], CUSTOMERS), table)
    return folder, table, log


def write(folder, name, *lines, header=HEADER):
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def ids(spark, table):
    return sorted(r[0] for r in ingest_stream.read_table(spark, table).select("customer_id").collect())


def statuses(spark, log, table=None):
    table = table or log[: -len("log")] + "table"
    return {r["file_name"].rsplit("/", 1)[-1]: r["status"] for r in ingest_stream.latest_status(ingest_stream.read_log(spark, log, table)).collect()}


def test_folder_run(spark, place, tmp_path):
    folder, table, log = place
    swapped = ",".join(reversed(HEADER.upper().split(",")))
    write(folder, "a.CSV", line(1), line(7), line(1, age=50), line(2, age=101), line(3, age="40.0"))
    write(folder, "b.csv", ",".join(reversed(line(4).split(","))), header=swapped)
    write(folder, "c.csv", line(5, age="old"))
    write(folder, "d.csv", line(6), header=HEADER.replace("Exited", "Left"))
    write(folder, "e.csv")
    write(folder, "f.csv", line(1))
    (folder / "notes.txt").write_text("no")
    added = []
    now = datetime(2026, 1, 2, 3, 4, 5)
    ingest_stream.ingest_folder(
        spark, str(folder), table, log, "one", archive=str(tmp_path / "archive"), now=now, on_rows_added=lambda batch, rows: added.append(rows)
    )
    assert ids(spark, table) == [1, 3, 4, 7] and added == [3]
    assert statuses(spark, log) == {
        "a.CSV": "ingested", "b.csv": "ingested", "c.csv": "unparsable", "d.csv": "missing_columns",
        "e.csv": "no_new_rows", "f.csv": "duplicate_ids",
    }
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["c.csv", "d.csv", "f.csv", "notes.txt"]
    archived = sorted(p.name for p in (tmp_path / "archive").iterdir() if not p.name.startswith("."))
    assert archived == ["a_20260102_030405.CSV", "b_20260102_030405.csv", "e_20260102_030405.csv"]
    # what was left is tried again: f has only known ids by now
    ingest_stream.ingest_folder(spark, str(folder), table, log, "two", now=datetime(2026, 1, 3), on_rows_added=lambda batch, rows: added.append(rows))
    assert ids(spark, table) == [1, 3, 4, 7] and added == [3]
    assert statuses(spark, log)["f.csv"] == "no_new_rows"


def test_replaying_a_batch_adds_nothing_twice(spark, place):
    folder, table, log = place
    write(folder, "a.csv", line(1), line(2))
    paths = batches.find_files(spark, str(folder))
    for _ in range(2):  # as after a crash between append and commit
        ingest_stream.ingest_files(spark, paths, table, log, "stream-0")
        assert ids(spark, table) == [1, 2, 7]
    assert ingest_stream.ingest_folder(spark, str(folder), table, log, "later") is None


def test_stream_takes_each_file_once(spark, place, tmp_path):
    folder, table, log = place
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        query = ingest_stream.stream_folder(spark, str(folder), table, log, checkpoint)
        assert query.awaitTermination(120)

    write(folder, "a.csv", line(1), line(2))
    write(folder, "b.CSV", line(3))
    run()
    assert ids(spark, table) == [1, 2, 3, 7]
    write(folder, "c.csv", line(2), line(4))
    run()
    run()
    assert ids(spark, table) == [1, 2, 3, 4, 7]
    assert statuses(spark, log) == {"a.csv": "ingested", "b.CSV": "ingested", "c.csv": "ingested"}


def test_scoring_json(spark):
    good = '{"credit_score": "720", "geography": "Delhi", "gender": "Male", "age": 28, "tenure": 4, "balance": 0, "num_products": 2, "has_credit_card": 1, "is_active_member": 1, "estimated_salary": "8500000.5"}'
    rows = batches.parse_scoring_json(
        spark.createDataFrame([(1, good), (2, good.replace("28", '"x"')), (3, good.replace('"tenure": 4, ', "")), (4, "{")], "i int, value string")
    ).orderBy("i").collect()
    assert [r["valid"] for r in rows] == [True, False, False, False]
    assert rows[0]["credit_score"] == 720 and rows[0]["estimated_salary"] == 8500000.5 and rows[0]["age"] == 28


def test_known_ids_are_found_without_shuffling_the_table(spark):
    from conftest import plan_of

    table = existing(spark, *range(1000))
    batch = incoming(spark, ("a", dict(customer_id=5000)), ("a", dict(customer_id=5)))
    fresh = ingest.new_records(batch, table)
    assert [r["customer_id"] for r in fresh.collect()] == [5000]
    assert "BroadcastHashJoin" in plan_of(fresh)


def test_headers_of_many_files_take_one_job(spark, place):
    folder, _, _ = place
    for i in range(200):
        write(folder, f"{i:03d}.csv", line(1000 + i), header=HEADER.upper() if i % 2 else HEADER)
    paths = batches.find_files(spark, str(folder))
    spark.sparkContext.setJobGroup("headers", "headers")
    found = batches._headers(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(found) == 200 and len(set(found.values())) == 2 and len(jobs) <= 3


def test_a_folder_in_parts(spark, place):
    folder, table, log = place
    for i in range(5):
        write(folder, f"{i}.csv", line(100 + i))
    ingest_stream.ingest_folder(spark, str(folder), table, log, "run", max_files=2)
    assert ids(spark, table) == [7, 100, 101, 102, 103, 104]
    assert set(statuses(spark, log).values()) == {"ingested"} and len(statuses(spark, log)) == 5


def test_quoted_line_breaks_stay_in_their_row(spark, place):
    folder, _, _ = place
    header = HEADER + ",Remark"
    write(folder, "a.csv", line(1) + ',"two\nlines"', line(2) + ",one", header=header)
    rows, refused = batches.read_files(spark, batches.find_files(spark, str(folder)))
    assert not refused and sorted(r["customer_id"] for r in rows.collect()) == [1, 2]


@pytest.mark.parametrize("mode", [ingest.REJECT_FILE, ingest.DROP_ROWS])
def test_decisions_do_not_follow_the_size_of_the_parts(spark, tmp_path, mode):
    """Files that share ids with earlier files, with the table, and with files that were rejected."""
    found = []
    for size in (1, 2, 3, 100):
        folder, table, log = tmp_path / f"in{size}", str(tmp_path / f"table{size}"), str(tmp_path / f"log{size}")
        folder.mkdir()
        ingest_stream.create_table(existing(spark, 7), table)
        write(folder, "a.csv", line(1), line(2))
        write(folder, "b.csv", line(2), line(3))
        write(folder, "c.csv", line(3), line(4))
        write(folder, "d.csv", line(7))
        write(folder, "e.csv", line(4), line(5, age=101))
        write(folder, "f.csv", line(5), line(6))
        logged = ingest_stream.ingest_folder(spark, str(folder), table, log, "run", max_files=size, mode=mode)
        rows = {tuple(str(v) for v in r) for r in ingest_stream.read_table(spark, table).collect()}
        counts = sorted((r["file_name"].rsplit("/", 1)[-1], *r[1:7]) for r in logged.collect())
        found.append((rows, counts))
    assert all(f == found[0] for f in found)
    assert {c[0]: c[1] for c in found[0][1]} == (
        {"a.csv": "ingested", "b.csv": "duplicate_ids", "c.csv": "ingested", "d.csv": "no_new_rows", "e.csv": "duplicate_ids", "f.csv": "ingested"}
        if mode == ingest.REJECT_FILE
        else {"a.csv": "ingested", "b.csv": "ingested", "c.csv": "ingested", "d.csv": "no_new_rows", "e.csv": "ingested", "f.csv": "ingested"}
    )


@pytest.mark.parametrize("lost", ["log", "marker"])
def test_a_batch_that_broke_off_is_not_seen(spark, place, monkeypatch, lost):
    """Its rows are written and then its log or its marker is not: the next run decides anew."""
    folder, table, log = place
    for i in range(3):
        write(folder, f"{i}.csv", line(100 + i), line(200))
    broken = "spark.createDataFrame" if lost == "log" else "create_once"

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_stream, "create_once", fail) if broken == "create_once" else patch.setattr(ingest_stream, "FILE_LOG", None)
        with pytest.raises(Exception):
            ingest_stream.ingest_folder(spark, str(folder), table, log, "run", max_files=2)
    assert ids(spark, table) == [7] and statuses(spark, log, table) == {}
    ingest_stream.ingest_folder(spark, str(folder), table, log, "run", max_files=1)
    assert ids(spark, table) == [7, 100, 200]
    assert statuses(spark, log, table) == {"0.csv": "ingested", "1.csv": "duplicate_ids", "2.csv": "duplicate_ids"}


def test_a_run_goes_on_where_it_broke_off(spark, place, monkeypatch):
    folder, table, log = place
    for i in range(3):
        write(folder, f"{i}.csv", line(100 + i), line(200 + i // 2))
    real, calls = ingest_stream.create_once, []

    def second_fails(*a):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("lost")
        return real(*a)

    with monkeypatch.context() as patch:
        patch.setattr(ingest_stream, "create_once", second_fails)
        with pytest.raises(OSError):
            ingest_stream.ingest_folder(spark, str(folder), table, log, "run", max_files=1)
    ingest_stream.ingest_folder(spark, str(folder), table, log, "run", max_files=1)
    assert ids(spark, table) == [7, 100, 102, 200, 201]
    assert statuses(spark, log, table) == {"0.csv": "ingested", "1.csv": "duplicate_ids", "2.csv": "ingested"}
