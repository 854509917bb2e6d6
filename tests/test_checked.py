"""Lines that do not fit, and records that do not come in time."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import bag
from vendaria import schemas
from vendaria.operators.quality import arrives_within
from vendaria.sources.files import read_csv, read_csv_checked

HEADER = ",".join(schemas.PRODUCT_ITEM.names)
GOOD = ["1,1,1,1,1.5", "2,2,2,,", '"3",3,3,3,"3"', "-4,4,4,4,1e3"]
BAD = {
    "x,1,1,1,1.5": [("prod_item_id", "x")],
    "5,1,1,one,two": [("item_quantity", "one"), ("purchase_value", "two")],
    "6,1,1,1": [(None, None)],
    "7,1,1,1,1.5,9": [(None, None)],
    "8,1,1,y,1.5,9": [(None, None)],
    "9 ,1,1,1,1.5": [("prod_item_id", "9 ")],
    "10.5,1,1,1,1.5": [("prod_item_id", "10.5")],
    "99999999999999999999,1,1,1,1.5": [("prod_item_id", "99999999999999999999")],
}


@pytest.fixture
def path(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADER, *GOOD[:2], *list(BAD)[:3], "", *GOOD[2:]]) + "\n")
    (folder / "b.csv").write_text("\n".join([HEADER, *list(BAD)[3:]]) + "\n")
    return str(folder)


def test_every_line_is_a_row_or_rejected(spark, path, tmp_path):
    checked = read_csv_checked(spark, path, schemas.PRODUCT_ITEM, str(tmp_path / "staging"))
    assert checked.rows.schema == schemas.PRODUCT_ITEM
    found = checked.rejected.collect()
    assert bag((r.line, r.column, r.cell) for r in found) == bag((k, *c) for k, cells in BAD.items() for c in cells)
    assert {r.file.rpartition("/")[2] for r in found} == {"a.csv", "b.csv"}
    lines = checked.rejected.select("line").distinct().count()
    assert checked.rows.count() + lines == len(GOOD) + len(BAD)


def test_good_rows_are_those_of_the_plain_reader(spark, path, tmp_path):
    rows = read_csv_checked(spark, path, schemas.PRODUCT_ITEM, str(tmp_path / "staging")).rows
    good = tmp_path / "good.csv"
    good.write_text("\n".join([HEADER, *GOOD]) + "\n")
    assert bag(rows.collect()) == bag(read_csv(spark, str(good), schemas.PRODUCT_ITEM).collect())


def test_what_is_rejected_does_not_depend_on_the_columns_asked_for(spark, path, tmp_path):
    checked = read_csv_checked(spark, path, schemas.PRODUCT_ITEM, str(tmp_path / "staging"))
    assert checked.rows.select("product_id").count() == len(GOOD)
    assert checked.rejected.select("column").count() == sum(map(len, BAD.values()))


def test_a_header_of_other_columns_is_refused_if_asked_for(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text(HEADER.replace("product_id", "producer_id") + "\n" + GOOD[0] + "\n")
    assert read_csv_checked(spark, str(file), schemas.PRODUCT_ITEM, str(tmp_path / "1")).rows.count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_checked(spark, str(file), schemas.PRODUCT_ITEM, str(tmp_path / "2"), check_header=True)
    file.write_text(HEADER + "\n" + GOOD[0] + "\n")
    assert read_csv_checked(spark, str(file), schemas.PRODUCT_ITEM, str(tmp_path / "3"), check_header=True).rows.count() == 1


def test_files_without_header_or_lines(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("\n".join([*GOOD, next(iter(BAD))]) + "\n")
    checked = read_csv_checked(spark, str(file), schemas.PRODUCT_ITEM, str(tmp_path / "1"), header=False)
    assert (checked.rows.count(), checked.rejected.count()) == (len(GOOD), 1)
    file.write_text(HEADER + "\n")
    checked = read_csv_checked(spark, str(file), schemas.PRODUCT_ITEM, str(tmp_path / "2"))
    assert (checked.rows.count(), checked.rejected.count()) == (0, 0)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    ("mine", "theirs", "violations"),
    [
        ([], [], 0),
        ([(1, "2023-01-01 10:00:00")], [], 1),
        ([(1, "2023-01-01 10:00:00")], [(1, "2023-01-04 10:00:00")], 0),
        ([(1, "2023-01-01 10:00:00")], [(1, "2023-01-04 10:00:01")], 1),
        ([(1, "2023-01-01 10:00:00")], [(1, "2022-12-01 00:00:00"), (1, "2023-01-09 00:00:00")], 0),
        ([(1, "2023-01-01 10:00:00"), (1, "2023-01-08 10:00:00")], [(1, "2023-01-05 00:00:00")], 1),
        ([(1, "2023-01-08 10:00:00")], [], 0),  # its time is not up yet
        ([(1, "2023-01-01 10:00:00")], [(1, "2023-01-11 00:00:00")], 1),
        ([(None, "2023-01-01 10:00:00"), (2, None)], [(3, "2023-01-01 00:00:00")], 0),
        ([(1, "2023-01-01 10:00:00"), (2, "2023-01-01 10:00:00"), (3, "2023-01-02 00:00:00")], [(2, "2023-01-02 00:00:00")], 2),
    ],
)
def test_records_that_do_not_come_in_time(spark, kind, mine, theirs, violations):
    one, two = (
        spark.createDataFrame(rows, "purchase_id long, t string").select(
            "purchase_id", F.col("t").cast(kind).alias("transaction_datetime")
        )
        for rows in (mine, theirs)
    )
    rule = arrives_within(one, two, "product_item", 3, datetime(2023, 1, 10)).collect()
    assert [tuple(r) for r in rule] == [("arrives_within(purchase_id -> product_item, 3 days)", violations)]
