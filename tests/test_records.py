"""Records that span lines, put together from ranges of the file, against the whole-file reader and Python's csv."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from retailmart.sources import records, staging

HEAD = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp"]


@pytest.fixture
def split(spark):
    """Ranges of the given number of bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def reviews(n, seed, end="\n"):
    rng = random.Random(seed)
    pieces = ["plain", "a, comma", 'a "quoted" word', f"two{end}lines", f"{end}", '""', '"', "é ß 日本", "x" * 90, f'end"{end}"begin', ""]
    return [[f"r{seed}-{i}", f"o{i}", str(rng.randint(1, 5)), rng.choice(pieces), " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))), "2018-01-01 00:00:00", ""] for i in range(n)]


def write(path, rows, end="\n", mark=b""):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([HEAD, *rows])
    path.write_bytes(mark + out.getvalue().encode())


def got(df):
    return sorted(tuple(v or "" for v in r) for r in df.collect())


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 27])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges(spark, tmp_path, split, size, end):
    rows = [reviews(n, s, end) for n, s in ((40, 1), (1, 2), (25, 3))]
    for i, r in enumerate(rows):
        write(tmp_path / f"{i}.csv", r, end, mark=b"\xef\xbb\xbf" if i == 1 else b"")
    split(size)
    want = sorted(tuple(v.replace(end, "\n") for v in r) for part in rows for r in part)
    assert got(records.scan_csv_records(spark, str(tmp_path))) == want


def test_same_as_whole_file(spark, tmp_path, split):
    write(tmp_path / "a.csv", reviews(120, 7))
    whole = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    split(50)
    ranges = records.scan_csv_records(spark, str(tmp_path))
    assert ranges.columns == whole.columns
    key = lambda r: tuple(repr(v) for v in r)
    assert sorted(map(key, ranges.collect())) == sorted(map(key, whole.collect()))


def test_one_file_is_many_tasks(spark, tmp_path, split):
    write(tmp_path / "a.csv", reviews(400, 5))
    split(2000)
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10
    df = staging.scan_csv_staging(spark, str(tmp_path), "stg_reviews")
    assert df.count() == 400 and "FileScan text" in df._jdf.queryExecution().toString()


def test_field_longer_than_ranges(spark, tmp_path, split):
    long = "\n".join(f'line {i} with "quotes"' for i in range(300))
    write(tmp_path / "a.csv", [["r1", "o", "1", "", long, "", ""], ["r2", "o", "2", "", "\n" * 50, "", ""], ["r3", "o", "3", "t", "m", "", ""]])
    split(100)
    assert got(records.scan_csv_records(spark, str(tmp_path))) == sorted([("r1", "o", "1", "", long, "", ""), ("r2", "o", "2", "", "\n" * 50, "", ""), ("r3", "o", "3", "t", "m", "", "")])


def test_unpaired_quotes_are_an_error(spark, tmp_path, split):
    (tmp_path / "a.csv").write_text(",".join(HEAD) + '\nr1,o,1,"open,m,,\nr2,o,2,t,m,,\n')
    split(16)
    with pytest.raises(PySparkException, match="quotes do not pair up"):
        records.scan_csv_records(spark, str(tmp_path)).collect()


def test_header_only_and_empty_lines(spark, tmp_path):
    write(tmp_path / "a.csv", [])
    assert records.scan_csv_records(spark, str(tmp_path)).collect() == []
    (tmp_path / "a.csv").write_text(",".join(HEAD) + "\n\nr1,o,1,t,m,,\n\n\nr2,o,2\n")
    assert [r[:3] for r in got(records.scan_csv_records(spark, str(tmp_path)))] == [("r1", "o", "1"), ("r2", "o", "2")]
