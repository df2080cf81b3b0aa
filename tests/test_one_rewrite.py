"""A run that moves orders and brings items rewrites the items once, with what two rewrites gave."""

import pytest

from support import day_batch, rows
from test_disk import land
from tidemark.plans import run as runs
from tidemark.plans.run import refine_all
from tidemark.plans.silver import audit_main, merge_batch, redate, refine
from tidemark.retail import ORDER_ITEMS, ORDERS
from tidemark.sources.store import Lake

DAYS = [day_batch(n, f"2024-01-0{n}") for n in (1, 2, 3)]
CHAIN = {s.name: s for s in (ORDERS, ORDER_ITEMS)}


def item(order, product="p", quantity="1"):
    return order, product, quantity, "2", "2"


def begun(lake):
    land(lake, ORDERS, [(f"o{n}", "c", f"2020-0{n}-05", "s") for n in range(1, 6)], DAYS[0])
    land(lake, ORDER_ITEMS, [item(f"o{n}", p) for n in range(1, 7) for p in ("p", "q")], DAYS[0])
    refine_all(lake, DAYS[0], CHAIN)
    # Moved: o1, o2; late: o6; another status only: o3. Items: one of o1 changed, one of o2 the same, one of o3 changed, one new.
    land(lake, ORDERS, [("o1", "c", "2021-01-05", "s"), ("o2", "c", "2021-02-05", "s"), ("o3", "c", "2020-03-05", "t"), ("o6", "c", "2021-06-05", "s")], DAYS[1])


BATCH = [item("o1", "p", "7"), item("o2", "p"), item("o3", "p", "8"), item("o4", "new")]


@pytest.fixture(params=["few", "large"])
def lakes(request, spark, tmp_path, monkeypatch):
    from tidemark.plans import silver

    if request.param == "few":
        monkeypatch.setattr(silver, "LARGE_SHARE", 0)
    return [Lake(spark, str(tmp_path / name)) for name in ("one", "two")]


def test_items_are_rewritten_once_and_hold_what_two_rewrites_gave(lakes):
    one, two = lakes
    for lake in lakes:
        begun(lake)
        land(lake, ORDER_ITEMS, BATCH, DAYS[1])
    assert one.manifest(ORDER_ITEMS).number == 1
    done = refine_all(one, DAYS[1], CHAIN)["order_items"]
    assert one.manifest(ORDER_ITEMS).number == 2
    # Orders first, then the dates in a rewrite of their own, then the batch.
    refine(two, ORDERS, DAYS[1], followers=[ORDER_ITEMS])
    apart = refine(two, ORDER_ITEMS, DAYS[1])
    assert two.manifest(ORDER_ITEMS).number == 3
    assert rows(one.main(ORDER_ITEMS)) == rows(two.main(ORDER_ITEMS))
    assert (done.updated, done.inserted, done.main_rows) == (apart.updated, apart.inserted, apart.main_rows) == (2, 1, 13)
    for lake in lakes:
        dates = {(r.order_id, r.product_id): str(r.order_date) for r in lake.main(ORDER_ITEMS).collect()}
        assert dates["o1", "p"] == dates["o1", "q"] == "2021-01-05" and dates["o2", "p"] == "2021-02-05"
        assert dates["o6", "q"] == "2021-06-05" and dates["o3", "p"] == "2020-03-05"
        assert {p.month for p in lake.manifest(ORDER_ITEMS).parts} == {d[:7] for d in dates.values()}
        assert redate(lake, ORDER_ITEMS, DAYS[1]) == 0
        audit_main(lake, ORDER_ITEMS)


def test_items_without_a_batch_or_merged_before_follow_at_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    begun(lake)
    assert refine_all(lake, DAYS[1], CHAIN)["order_items"] is None
    dates = {r.order_id: str(r.order_date) for r in lake.main(ORDER_ITEMS).collect()}
    assert dates["o1"] == "2021-01-05" and dates["o6"] == "2021-06-05"
    # A run whose orders come after its items were merged.
    land(lake, ORDER_ITEMS, [item("o1", "late")], DAYS[2])
    refine(lake, ORDER_ITEMS, DAYS[2])
    land(lake, ORDERS, [("o1", "c", "2022-01-05", "s")], DAYS[2])
    refine_all(lake, DAYS[2], CHAIN)
    found = {str(r.order_date) for r in lake.main(ORDER_ITEMS).filter("order_id = 'o1'").collect()}
    assert found == {"2022-01-05"}


def test_a_run_that_dies_after_its_orders_can_be_repeated(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    begun(lake)
    land(lake, ORDER_ITEMS, BATCH, DAYS[1])
    plain = runs.refine

    def dying(lake, spec, *args, **kwargs):
        if spec is ORDER_ITEMS:
            raise RuntimeError("gone")
        return plain(lake, spec, *args, **kwargs)

    monkeypatch.setattr(runs, "refine", dying)
    with pytest.raises(RuntimeError, match="gone"):
        refine_all(lake, DAYS[1], CHAIN)
    monkeypatch.undo()
    assert lake.is_done(2, "orders.merged")
    refine_all(lake, DAYS[1], CHAIN)
    dates = {(r.order_id, r.product_id): str(r.order_date) for r in lake.main(ORDER_ITEMS).collect()}
    assert dates["o1", "q"] == "2021-01-05" and dates["o6", "p"] == "2021-06-05"
    # Merging the same batch again moves nothing.
    version = lake.manifest(ORDER_ITEMS).number
    assert merge_batch(lake, ORDER_ITEMS, DAYS[1], follows=True).updated == 0
    assert lake.manifest(ORDER_ITEMS).number == version
