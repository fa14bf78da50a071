"""Tiles of items: whole sums without shuffling pairs, however candidates are completed."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of

from tallyloom.operators import allpairs as ap
from tallyloom.operators import tiles

RATINGS = "user_id int, item_id int, rating double"


def ratings(seed, users=60, items=30):
    rng = random.Random(seed)
    return [(u, f"i{i}", float(rng.randint(1, 5))) for u in range(users) for i in range(items)
            if u < 2 or rng.random() < 0.15]


def brute_force(rows, common):
    of = {}
    for user, item, rating in rows:
        of.setdefault(item, {})[user] = rating
    found = {}
    for a, b in combinations(sorted(of), 2):
        both = sorted(of[a].keys() & of[b].keys())
        x, y = np.array([of[a][u] for u in both]), np.array([of[b][u] for u in both])
        if len(both) >= common:
            found[a, b] = (len(both), x.sum(), y.sum(), x @ x, y @ y, x @ y, x.min(), x.max(), y.min(), y.max())
    return found


@pytest.mark.parametrize("lookup", [0, 100])
@pytest.mark.parametrize("step", [7, 1000])
@pytest.mark.parametrize("dense", [0, 8])
@pytest.mark.parametrize("groups", [1, 3])
def test_tiles_agree_with_brute_force(monkeypatch, lookup, step, groups, dense):
    """Users 0 and 1 rate everything and are not listed; in a second run each item has two
    other raters that are not."""
    monkeypatch.setattr(tiles, "LOOKUP", lookup)
    monkeypatch.setattr(tiles, "STEP", step)
    monkeypatch.setattr(tiles, "DENSE", dense)
    rows, common = ratings(groups), 3
    last = {}
    for user, item, _ in rows:
        last.setdefault(item, []).append(user)
    for unlisted in ({i: (0, 1) for i in last}, {i: users[-2:] for i, users in last.items()}):
        parts = [[r for r in rows if int(r[1][1:]) % groups == g] for g in range(groups)]
        tables = [pa.table({
            "user_id": [u for u, _, _ in part], "item_id": [i for _, i, _ in part], "rating": [r for _, _, r in part],
            "listed": [u not in unlisted[i] for u, i, _ in part]}) for part in parts]
        found = {}
        for p in range(groups):
            for q in range(p, groups):
                tile = tiles.Tile(tables[p], tables[q], p == q)
                for chunk in tile.chunks():
                    for row in tile.batch(*tile.sums(*chunk, common, tiles.ALL_SUMS)).to_pylist():
                        pair = row.pop("item_a"), row.pop("item_b")
                        assert pair not in found
                        found[pair] = tuple(row.values())
        listed = {pair: n for pair, n in brute_force([r for r in rows if r[0] not in unlisted[r[1]]], 1).items()}
        assert found == {pair: sums for pair, sums in brute_force(rows, common).items() if pair in listed}
        assert len(found) > 20


def test_every_tile_is_taken_once():
    assert [tiles.tile_at(n, 4) for n in range(10)] == [(p, q) for p in range(4) for q in range(p, 4)]


@pytest.mark.parametrize("plan", ["pairs", "prefix"])
def test_pairs_are_never_shuffled(spark, plan):
    rows = [(u, i, float(u % 3)) for u in range(12) for i in range(6)]
    sums = ap.sums_of_pairs(spark.createDataFrame(rows, RATINGS), 2, 5000, plan)
    assert "Exchange" not in plan_of(sums) and sums.count() == 15
