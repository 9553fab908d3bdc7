import os
import tempfile

from basketry.sources.formats import read_pairs, read_purchases_csv, read_text_lines, rejected_pair_lines
from basketry.sources.sinks import fixed_decimals, write_csv, write_key_value_text, write_pairs


def _tmp():
    return tempfile.mkdtemp(prefix="basketry-test-")


def test_purchases_csv(spark):
    d = _tmp()
    path = os.path.join(d, "baskets.csv")
    with open(path, "w") as f:
        f.write("Member_number,Date,itemDescription,year,month,day\n")
        f.write("1808, 21/07/2015 ,tropical fruit,2015,7,21\n")
        f.write('2552,05/01/2015,"frozen, vegetables",2015,1,5\n')
    df = read_purchases_csv(spark, path, date_format="dd/MM/yyyy")
    rows = df.collect()
    assert [r.customer_id for r in rows] == [1808, 2552]
    assert rows[1].product == "frozen, vegetables" and str(rows[0].date) == "2015-07-21"


def test_purchases_csv_fails_fast(spark):
    import pytest

    d = _tmp()
    path = os.path.join(d, "bad.csv")
    with open(path, "w") as f:
        f.write("Member_number,Date,itemDescription,year,month,day\n1,01/01/2015,milk,x,1,1\n")
    with pytest.raises(Exception):
        read_purchases_csv(spark, path).collect()
    # only the first line is a header: a repeated header is a malformed row
    again = os.path.join(d, "again.csv")
    with open(again, "w") as f:
        f.write("Member_number,Date,itemDescription,year,month,day\n1,01/01/2015,milk,2015,1,1\n")
        f.write("Member_number,Date,itemDescription,year,month,day\n")
    with pytest.raises(Exception):
        read_purchases_csv(spark, again).collect()


def _csv(lines, name="x.csv"):
    path = os.path.join(_tmp(), name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_purchases_csv_binds_by_header(spark):
    path = _csv(["year,day,extra,month,Date,itemDescription,Member_number", "2015,5,e,3,05/03/2015,milk,7"])
    row = read_purchases_csv(spark, path, "dd/MM/yyyy").first()
    assert (row.customer_id, str(row.date), row.product, row.year, row.month, row.day) == (7, "2015-03-05", "milk", 2015, 3, 5)
    assert read_purchases_csv(spark, path).columns == ["customer_id", "date", "product", "year", "month", "day"]


def test_purchases_csv_with_a_missing_column(spark):
    import pytest

    with pytest.raises(ValueError, match="month"):
        read_purchases_csv(spark, _csv(["Member_number,Date,itemDescription,year,day", "1,01/01/2015,milk,2015,1"]))


def test_purchases_csv_files_with_different_headers(spark):
    import pytest

    folder = _tmp()
    for name, lines in (("a.csv", ["Member_number,Date,itemDescription,year,month,day", "1,01/02/2015,milk,2015,2,1"]),
                        ("b.csv", ["Member_number,Date,itemDescription,year,day,month", "1,01/02/2015,milk,2015,1,2"])):
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    with pytest.raises(Exception):
        read_purchases_csv(spark, folder).collect()


def test_malformed_lines_fail_in_pruned_plans(spark):
    import pytest

    head = "Member_number,Date,itemDescription,year,month,day"
    for bad in ("1,01/01/2015,milk,20x5,1,1", "1,01/01/2015,milk,2015,1,1,9", "1,01/01/2015,milk,2015,1", "1.5,01/01/2015,milk,2015,1,1"):
        path = _csv([head, "2,02/01/2015,tea,2015,1,2", bad])
        with pytest.raises(Exception):
            read_purchases_csv(spark, path).select("customer_id", "date", "month").collect()
        with pytest.raises(Exception):
            read_purchases_csv(spark, path).count()
    good = read_purchases_csv(spark, _csv([head, "2,02/01/2015,tea,2015,1,2", ",,,,,"]))
    assert good.select("month").count() == 2  # empty fields are nulls, not malformed


def test_items_are_trimmed(spark):
    from basketry.sources.formats import parse_basket_lines

    lines = spark.createDataFrame([("  b1 ,\t milk\t, bread ,milk",)], "value string")
    assert [(r.basket_id, r["items"]) for r in parse_basket_lines(lines).collect()] == [("b1", ["milk", "bread"])]


def test_ordered_pair_file(spark):
    import glob

    rows = [(f"i{k % 7}", f"j{k % 13:02d}", k) for k in range(91)]
    d = _tmp()
    write_pairs(spark.createDataFrame(rows, "item_a string, item_b string, support long").repartition(5), f"{d}/p", ordered=True)
    lines = [x for part in sorted(glob.glob(f"{d}/p/part-*")) for x in open(part).read().splitlines()]
    assert lines == sorted(f"{a}|{b}\t{n}" for a, b, n in rows)


def test_pair_file_round_trip(spark):
    d = _tmp()
    pairs = spark.createDataFrame([("a", "b", 3), ("b", "c", 10)], "item_a string, item_b string, support long")
    write_pairs(pairs, os.path.join(d, "pairs"))
    back = read_pairs(spark, os.path.join(d, "pairs"))
    assert sorted(tuple(r) for r in back.collect()) == [("a", "b", 3), ("b", "c", 10)]
    lines = spark.createDataFrame([("a|b\t3",), ("a|b",), ("ab\t3",), ("a|b\tx",), ("a|b|c\t1",)], "value string")
    assert sorted(r.line for r in rejected_pair_lines(lines).collect()) == sorted(["a|b", "a|b\tx", "a|b|c\t1", "ab\t3"])


def test_sinks(spark):
    d = _tmp()
    df = spark.createDataFrame([("w", 2)], "word string, n long")
    write_key_value_text(df, "word", "n", os.path.join(d, "kv"))
    assert [r.value for r in read_text_lines(spark, os.path.join(d, "kv")).collect()] == ["w\t2"]
    write_csv(df, os.path.join(d, "csv"))
    write_csv(df, os.path.join(d, "csv"))  # overwrite by default
    assert spark.read.csv(os.path.join(d, "csv")).count() == 1
    x = spark.createDataFrame([(4.949747468305833,)], "x double")
    assert x.select(fixed_decimals("x").alias("s")).first().s == "4.9497"


def test_pair_file_keeps_odd_names(spark, tmp_path):
    """Pipes, tabs, line ends, backslashes and empty names come back; plain names are written as they are."""
    import itertools
    import random

    from basketry.sources.sinks import pair_lines, write_pairs

    rng = random.Random(2)
    names = ["".join(p) for n in range(4) for p in itertools.product("\\|te", repeat=n)]
    names += ["".join(rng.choices("ab\\|\t\n\rpnrteé日", k=rng.randrange(1, 12))) for _ in range(300)]
    rows = [(a, b, k) for k, (a, b) in enumerate(zip(names, reversed(names)))]
    df = spark.createDataFrame(rows, "item_a string, item_b string, support long")
    write_pairs(df, str(tmp_path / "pairs"))
    back = read_pairs(spark, str(tmp_path / "pairs"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert rejected_pair_lines(spark.read.text(str(tmp_path / "pairs"))).collect() == []
    plain = spark.createDataFrame([("whole milk", "yögurt", 3)], "item_a string, item_b string, support long")
    assert pair_lines(plain).first().value == "whole milk|yögurt\t3"
    # a file of another writer: a backslash that escapes nothing stays
    lines = spark.createDataFrame([("a\\x|b\\\t2",)], "value string")
    from basketry.sources.formats import parse_pair_lines
    assert [tuple(r) for r in parse_pair_lines(lines).collect()] == [("a\\x", "b\\", 2)]


def test_skipped_lines_are_counted_in_the_same_pass(spark):
    from pyspark.sql import Observation

    from basketry.sources import formats as fm

    def counted(parse, lines):
        seen = Observation()
        rows = parse(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3), observation=seen).collect()
        return len(rows), seen.get

    assert counted(fm.parse_edge_lines, ["a b", " a\tc ", "", " ", None, "a", "a b c", "a b c d"]) == (
        2, {"lines": 8, "empty": 3, "one_field": 1, "many_fields": 2})
    assert counted(fm.parse_basket_lines, ["1,a,b", "2, ,", "3", ",a", "", None]) == (1, {"lines": 6, "no_id": 3, "no_items": 2})
    assert counted(fm.parse_pair_lines, ["a|b\t3", "a|b\tx", "a|b", "|b\t3", None]) == (1, {"lines": 5, "malformed": 4})
    assert counted(fm.parse_edge_lines, []) == (0, {"lines": 0, "empty": 0, "one_field": 0, "many_fields": 0})
