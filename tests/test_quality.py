import pytest

from fixtures import ITEMS, PURCHASES
from vendaria import schemas
from vendaria.operators.quality import audit, enforce, not_null, quality_gate, refers_to, unique
from vendaria.sources.files import from_rows


def test_gate(spark):
    item = from_rows(spark, [*ITEMS, ITEMS[0], ITEMS[0], (None, 1, 1, 1, 1.0), (None, 1, 1, 1, 1.0)], schemas.PRODUCT_ITEM)
    purchase = from_rows(spark, PURCHASES, schemas.PURCHASE)
    key = ["prod_item_id", "prod_item_partition"]
    gate = quality_gate(
        not_null(purchase, ["purchase_id", "release_date"]),
        unique(purchase, ["purchase_id"]),
        unique(item, key),
        refers_to(purchase, key, item, "product_item"),
    )
    assert {r.rule: (r.violations, r.passed) for r in gate.collect()} == {
        "not_null(purchase_id)": (0, True),
        "not_null(release_date)": (1, False),
        "unique(purchase_id)": (0, True),
        "unique(prod_item_id, prod_item_partition)": (2, False),
        "refers_to(prod_item_id, prod_item_partition -> product_item)": (1, False),
    }
    with pytest.raises(ValueError, match=r"unique\(prod_item_id, prod_item_partition\): 2 rows"):
        enforce(gate)
    enforce(quality_gate(unique(purchase, ["purchase_id"])))


def test_one_pass_finds_the_same(spark):
    rows = [*ITEMS, ITEMS[0], ITEMS[0], (None, 1, 1, 1, 1.0), (None, 1, None, 1, 1.0), (None, 1, 1, 1, None)]
    item = from_rows(spark, rows, schemas.PRODUCT_ITEM)
    columns, key = item.columns, ["prod_item_id", "prod_item_partition"]
    for table in (item, item.limit(0)):
        apart = quality_gate(not_null(table, columns), unique(table, key))
        assert sorted(quality_gate(audit(table, columns, key)).collect()) == sorted(apart.collect())
    assert audit(item, [], key).count() == 1


def test_empty_input_passes(spark):
    nothing = from_rows(spark, PURCHASES, schemas.PURCHASE).limit(0)
    gate = quality_gate(not_null(nothing, ["buyer_id"]), unique(nothing, ["purchase_id"]))
    assert [(r.violations, r.passed) for r in gate.collect()] == [(0, True), (0, True)]
