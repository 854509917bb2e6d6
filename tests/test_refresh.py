"""Layers that a batch refreshes: the same rows as when all is built anew, and other days stay as they are."""

import random
from pathlib import Path

import pytest

from fixtures import bag
from test_state import CUTS, purchases, union, with_status
from test_stream import random_feeds
from vendaria.operators.cdc import Feeds, latest_feeds, valid_purchase
from vendaria.operators.gmv import gmv_daily
from vendaria.operators.quality import audit, quality_gate
from vendaria.plans import layers
from vendaria.plans.layers import read_bronze, read_gold, read_silver, refresh_layers
from vendaria.plans.state import Kept, Rules


def keys_only(daily):
    return quality_gate(audit(daily, ["transaction_date"], ["transaction_date", "subsidiary"]))


def types_of(records):
    return {name: df.schema for name, df in records._asdict().items()}


def files(base):
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in Path(base).rglob("*.parquet")}


def compare(spark, base, seen, rules):
    """All layers against the whole records."""
    types = types_of(seen)
    for stored, given in zip(read_bronze(spark, base, types), seen):
        assert bag(stored.collect()) == bag(given.collect())
    latest = latest_feeds(seen, status_col=rules.status_col)
    latest = latest._replace(purchase=valid_purchase(latest.purchase, rules.status_col))
    for stored, given in zip(read_silver(spark, base, types), latest):
        assert stored.columns == given.columns
        assert bag(stored.collect()) == bag(given.collect())
    assert bag(read_gold(spark, base).collect()) == bag(gmv_daily(seen, status_col=rules.status_col).collect())


def test_batches_in_any_order_equal_whole_layers(spark, tmp_path, monkeypatch):
    """Later records first; with a hot and a missing id; the last batch is lost on the way and repeated."""
    rules, base = Rules("status"), str(tmp_path / "layers")
    between = random_feeds(spark, 4, 150)
    batches = [with_status(between(a, b)) for a, b in zip(CUTS, CUTS[1:])]
    random.Random(2).shuffle(batches)
    kept = Kept(str(tmp_path / "state"), rules, ids_per_block=9)
    for number, batch in enumerate(batches[:-1]):
        refresh_layers(spark, batch, base, kept, number, keys_only)
    compare(spark, base, union(batches[:-1]), rules)

    def dies(*arguments):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        write = layers.write_parts
        patch.setattr(layers, "write_parts", lambda rows, path, *rest: dies() if "gold" in path else write(rows, path, *rest))
        with pytest.raises(RuntimeError):
            refresh_layers(spark, batches[-1], base, kept, len(batches) - 1, keys_only)
    refresh_layers(spark, batches[-1], base, kept, len(batches) - 1, keys_only)
    compare(spark, base, union(batches), rules)


def test_a_late_batch_changes_the_files_of_its_days(spark, tmp_path):
    """The days it leaves become empty, those it comes to are written, and all other files stay."""
    base = str(tmp_path / "layers")
    kept = Kept(str(tmp_path / "state"), ids_per_block=10)
    with_days = lambda f: Feeds(*[p.selectExpr("*", "CAST(transaction_datetime AS DATE) AS transaction_date") for p in f])
    first = with_days(purchases(spark, (0, 3), "2023-01-01", "2023-02-01"))
    more = with_days(purchases(spark, (20, 30), "2023-01-02", "2023-02-11"))
    refresh_layers(spark, union([first, more]), base, kept, 0)
    before = files(base)
    late = with_days(purchases(spark, (0, 3), "2023-03-01", "2023-02-04"))
    days = refresh_layers(spark, late, base, kept, 1)
    assert sorted(str(r[0]) for r in days.collect()) == [f"2023-02-0{d}" for d in range(1, 7)]
    after = files(base)
    assert {f: t for f, t in after.items() if f in before} == before
    changed = {f"{Path(f).parts[0]}/{Path(f).parts[1]}/{Path(f).parts[2]}" for f in set(after) - set(before)}
    assert changed == {
        *[f"gold/gmv_daily/transaction_date=2023-02-0{d}" for d in (4, 5, 6)],
        *[f"silver/purchase/gmv_date=2023-02-0{d}" for d in (4, 5, 6)],
        *[f"{layer}/{feed}/transaction_date=2023-03-01" for layer in ("bronze",) for feed in Feeds._fields],
        *[f"silver/{feed}/transaction_date=2023-03-01" for feed in ("product_item", "extra_info")],
        *[f"latest/{feed}/block=0" for feed in Feeds._fields],
    }
    assert bag(read_gold(spark, base).collect()) == bag(gmv_daily(union([first, more, late])).collect())
    assert read_silver(spark, base, types_of(late)).purchase.count() == 13


def test_the_gate_stops_a_batch_before_any_layer_changes(spark, tmp_path):
    base, kept = str(tmp_path / "layers"), Kept(str(tmp_path / "state"))
    records = random_feeds(spark, 4, 60)("", "2023-02-01")
    with pytest.raises(ValueError, match="gmv_daily"):
        refresh_layers(spark, records, base, kept, 0)
    assert not files(tmp_path / "layers")
    refresh_layers(spark, records, base, kept, 0, keys_only)
    assert bag(read_gold(spark, base).collect()) == bag(gmv_daily(records).collect())
