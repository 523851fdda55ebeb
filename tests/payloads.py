"""Landed files written by the tests."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path


def millis(text: str) -> int:
    stamp = dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
    return int(stamp.timestamp() * 1000)


def coin(name: str, price, **more) -> dict:
    return {
        "id": name,
        "symbol": name[:3],
        "name": name.title(),
        "image": "x.png",
        "current_price": price,
        "market_cap": 4400,
        "market_cap_rank": 1,
        "total_volume": 320,
        "max_supply": None,
        "roi": None,
        "last_updated": "2031-03-04T22:30:00.000Z",
        **more,
    }


def write_snapshot(folder: Path, stamp: str, coins: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"snapshot_markets_{stamp}.json").write_text(json.dumps(coins, indent=2))


def write_history(folder: Path, name: str, stamp: str, points: list, caps=None, volumes=None) -> None:
    """``points`` are (timestamp text, price) pairs; caps and volumes default to the same grid."""
    folder.mkdir(parents=True, exist_ok=True)
    grid = [[millis(t), p] for t, p in points]
    payload = {
        "prices": grid,
        "market_caps": [[t, p * 10] for t, p in grid] if caps is None else caps,
        "total_volumes": [[t, 1000] for t, _ in grid] if volumes is None else volumes,
    }
    (folder / f"history_{name}_{stamp}.json").write_text(json.dumps(payload, indent=2))
