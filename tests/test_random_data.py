"""Random dirty rows against a plain loop over the rows, and rules that hold for any input."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from conftest import row
from pyspark.sql import functions as F

from ordermill.operators import aggregates
from ordermill.operators.cleaning import clean_sales
from ordermill.operators.disposition import cleaning_stats, dispose_rows


def dirty_rows(seed, n=400):
    rng = random.Random(seed)
    pick = rng.choice
    return [
        row(
            order_id=pick([None, "hot", "hot", f"o{rng.randint(0, n // 2)}"]),
            order_date=pick([f"202{rng.randint(1, 3)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"] * 6 + ["?", None]),
            customer_name=pick(["Ann", " Bo ", "Cy", "Di", "", None]),
            region=pick(["north", " SOUTH", "east-west", "nan", ""]),
            product_category=pick(["a", "b", "", "c"]),
            product_name=pick(["p", "q", "r", "s ", "nan"]),
            quantity=pick([str(rng.randint(-1, 9)), str(rng.randint(1, 9)), None]),
            unit_price=pick([f"{rng.randint(-100, 9999) / 100}", f"{rng.randint(0, 9999) / 100}", None]),
            discount=pick([f"{rng.randint(-20, 120) / 100}", None, "0.15"]),
        )
        for _ in range(n)
    ]


def clean_by_loop(rows):
    counts = dict.fromkeys(["missing", "duplicate", "quantity", "price", "kept"], 0)
    seen, kept = set(), []
    for r in rows:
        name = (r["customer_name"] or "").strip()
        try:
            day = date.fromisoformat(r["order_date"] or "")
        except ValueError:
            day = None
        if not day or name in ("", "nan") or r["unit_price"] is None:
            counts["missing"] += 1
        elif r["order_id"] in seen:
            counts["duplicate"] += 1
        else:
            seen.add(r["order_id"])
            quantity = float(r["quantity"]) if r["quantity"] is not None else 0.0
            price = float(r["unit_price"])
            if not quantity > 0:
                counts["quantity"] += 1
            elif not price >= 0:
                counts["price"] += 1
            else:
                counts["kept"] += 1
                off = min(max(float(r["discount"] or 0), 0.0), 1.0)
                total = Decimal(str(float(np.round(quantity * price * (1 - off), 2)))).quantize(Decimal("0.01"))
                region = r["region"].strip().title()
                kept.append((r["order_id"], day, region if region not in ("Nan", "") else None, quantity, total))
    return kept, counts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cleaning_and_counts_against_a_loop(frame, seed):
    rows = dirty_rows(seed)
    df = frame(*rows).repartition(5)
    expected, counts = clean_by_loop(rows)
    clean = clean_sales(df, ["pos"])
    got = [tuple(r) for r in clean.select("order_id", "order_date", "region", "quantity", "total_amount").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert cleaning_stats(dispose_rows(df, ["pos"])).first().asDict() == {
        "rows_read": len(rows),
        "rows_dropped_missing_required": counts["missing"],
        "rows_dropped_duplicates": counts["duplicate"],
        "rows_dropped_bad_quantity": counts["quantity"],
        "rows_dropped_bad_price": counts["price"],
        "rows_cleaned": counts["kept"],
        "rows_rejected": len(rows) - counts["kept"],
    }


@pytest.mark.parametrize("seed", [4, 5])
def test_group_totals_against_a_loop(frame, seed):
    rows = dirty_rows(seed)
    clean = clean_sales(frame(*rows), ["pos"])
    totals = defaultdict(lambda: [0, 0.0, Decimal(0)])
    months = defaultdict(Decimal)
    for order_id, day, region, quantity, total in clean_by_loop(rows)[0]:
        months[day.strftime("%Y-%m")] += total
        if region is not None:
            totals[region][0] += order_id is not None
            totals[region][1] += quantity
            totals[region][2] += total
    got = aggregates.aggregate_by_region(clean).collect()
    assert {r.region: [r.total_orders, r.total_quantity, r.total_revenue] for r in got} == dict(totals)
    assert {r.period: r.total_revenue for r in aggregates.monthly_trend(clean).collect()} == dict(months)
    for r in got:
        assert float(r.avg_order_value) == float(np.round(float(r.total_revenue) / r.total_orders, 2))

    by_month = aggregates.monthly_region_summary(clean)
    assert by_month.agg(F.sum("total_revenue")).first()[0] == sum(r.total_revenue for r in got)
    assert by_month.agg(F.sum("total_orders")).first()[0] == sum(r.total_orders for r in got)
