"""Records of split files: numbers and cells equal those of a plain reader."""

import csv
import io
import os
import random

import pytest

from impactspark.sources import read_blocks, read_header_csv, read_positional, read_records
from impactspark.sources.records import ends_open, filled_width

from .conftest import rows

WIDTH = 5


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding=encoding) as f:
        f.write(text)


def messy(seed, n, breaks=True):
    """CSV text of cells with quotes, separators, line breaks and blank lines."""
    rng = random.Random(seed)
    parts = ["a", "é", ",", '"', " ", "x y", "0123", "日本", "", "'", "#"] + ["\n"] * breaks
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    for k in range(n):
        w.writerow([f"r{k}"] + ["".join(rng.choice(parts) for _ in range(rng.randrange(6))) for _ in range(WIDTH - 1)])
        if rng.random() < 0.05:
            out.write("\n")
    return out.getvalue()


def plain(texts):
    """``(cells, row)`` by Python's own reader; empty cells are NULL, blank lines no rows."""
    out = []
    for t in texts:
        kept = [r for r in csv.reader(io.StringIO(t)) if r]
        out += [(*[c or None for c in r], k) for k, r in enumerate(kept)]
    return sorted(out, key=repr)


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_cells_and_row_numbers_equal_a_plain_reader(spark, tmp_path, tiny_splits):
    texts = [messy(1, 700), messy(2, 40), messy(3, 300, breaks=False), "", "\n\n", "only,one,row,x,y"]
    for k, t in enumerate(texts):
        write(f"{tmp_path}/in/{k}.csv", t)
    assert spark.read.text(f"{tmp_path}/in").rdd.getNumPartitions() > 10, "files are split"
    df = read_positional(spark, f"{tmp_path}/in", range(WIDTH), list("abcde"))
    got = sorted(((*[r[c] or None for c in "abcde"], r["_row"]) for r in df.collect()), key=repr)
    assert got == plain(texts)


def test_row_numbers_do_not_depend_on_the_splits(spark, tmp_path, tiny_splits):
    write(f"{tmp_path}/in/a.csv", messy(4, 900))
    many = rows(read_records(spark, f"{tmp_path}/in"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100000000")
    assert spark.read.text(f"{tmp_path}/in").rdd.getNumPartitions() == 1
    assert rows(read_records(spark, f"{tmp_path}/in")) == many and len(many) == 900


def test_equal_to_the_multiline_reader_with_windows_line_ends(spark, tmp_path, tiny_splits):
    text = messy(5, 400).replace("\n", "\r\n")
    write(f"{tmp_path}/in/a.csv", text)
    names = [f"_c{i}" for i in range(WIDTH)]
    want = spark.read.option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/in", schema=", ".join(f"{n} string" for n in names))
    norm = lambda rs: sorted((tuple((c or "").replace("\r\n", "\n") for c in r[:WIDTH]) for r in rs))
    assert norm(read_positional(spark, f"{tmp_path}/in", range(WIDTH), names).collect()) == norm(want.collect())


def test_header_is_taken_once_and_must_agree(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", "id,name,,name\n007,x,y,z\n", encoding="utf-8-sig")
    write(f"{tmp_path}/in/b.csv", 'id,name,,name\n"1\n2",,,\n')
    df = read_header_csv(spark, f"{tmp_path}/in")
    assert df.columns == ["id", "name1", "_c2", "name3", "_file", "_row"]
    assert rows(df, "id", "name1", "_row") == [("007", "x", 0), ("1\n2", None, 0)]
    write(f"{tmp_path}/in/c.csv", "id,other,,name\n1,2,3,4\n")
    with pytest.raises(ValueError, match=r"c\.csv: its header differs"):
        read_header_csv(spark, f"{tmp_path}/in")


def test_an_open_quote_is_refused_by_name(spark, tmp_path, tiny_splits):
    write(f"{tmp_path}/in/good.csv", messy(6, 50))
    write(f"{tmp_path}/in/bad.csv", messy(7, 200) + 'x,"never closed\nmore\n')
    with pytest.raises(ValueError, match=r"never closed in .*bad\.csv"):
        read_records(spark, f"{tmp_path}/in")


@pytest.mark.parametrize("line,outside,inside", [
    ("a,b", False, True), ('a,"b', True, False), ('"a"', False, False), ('5" pipe,x', False, False), ('"a""', True, False),
    ('a,"b""c"', False, False), ("", False, True), ('"', True, False), ('""', False, True), ('a"b,"c', True, True), ('"a"x"y,"', True, True)])
def test_line_states(line, outside, inside):
    assert ends_open(line, False) is outside
    assert ends_open(line, True) is inside


def test_each_file_has_its_own_layout(spark, tmp_path):
    """Two and four blocks in one folder give the rows of two scans; a broken file is named."""
    from impactspark.plans import earnings as earn

    def block(n):
        return [str(100 * n), f"0{n}/06/2026", f"x{n}", "Impact gig", 'Gig, "quoted"\nname']

    def sheet(path, people, k):
        out = io.StringIO()
        w = csv.writer(out)
        w.writerow(["", "email", "cohort"] + [f"h{i}" for i in range(5 * k)] + ["", ""])
        for p in people:
            w.writerow(["", p, "C"] + [c for n in range(1, k + 1) for c in block(n)])
        write(path, out.getvalue())

    sheet(f"{tmp_path}/both/two.csv", ["a@x.org", "b@x.org"], 2)
    sheet(f"{tmp_path}/both/four.csv", ["c@x.org"], 4)
    sheet(f"{tmp_path}/two/two.csv", ["a@x.org", "b@x.org"], 2)
    sheet(f"{tmp_path}/four/four.csv", ["c@x.org"], 4)
    df, k = read_blocks(spark, f"{tmp_path}/both", lead_rows=1)
    assert k == 4 and rows(df.select("umuzi_email", "_blocks")) == [("a@x.org", 2), ("b@x.org", 2), ("c@x.org", 4)]
    name = lambda f: [*earn.CANON_COLS, "_row"]
    both = rows(earn.load_wide(spark, f"{tmp_path}/both", "s", 1), *name(0))
    apart = rows(earn.load_wide(spark, f"{tmp_path}/two", "s", 1), *name(0)) + rows(earn.load_wide(spark, f"{tmp_path}/four", "s", 1), *name(0))
    assert both == sorted(apart, key=lambda t: tuple((x is not None, x) for x in t)) and len(both) == 8
    sheet(f"{tmp_path}/both/odd.csv", ["d@x.org"], 2)
    with open(f"{tmp_path}/both/odd.csv", "a", encoding="utf-8") as f:
        f.write(",e@x.org,C,1,2,3,4,5,6\n".replace(",6", ",6,7,8,9,10,11"))
    with pytest.raises(ValueError, match=r"odd\.csv: 13 columns are not 2 \+ k\*5"):
        read_blocks(spark, f"{tmp_path}/both", lead_rows=1)


def test_filled_width(spark):
    cases = {"": 0, ",,,": 0, "a": 1, "a,,": 1, ',,"",': 3, 'a,"b,c,d",,': 2, 'a,"x\ny, ""z""",1,,': 3, ", ,": 2, '"' + "y" * 50_000 + '",b': 2}
    df = spark.createDataFrame(list(cases.items()), "record string, want int")
    for r in df.select("want", filled_width().alias("got")).collect():
        assert r["got"] == r["want"]
