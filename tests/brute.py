"""Plain Python figures to compare with, and random ledgers."""

import datetime as dt
import random
from collections import defaultdict


def address(n):
    return f"0x{n:040x}"


def random_ledger(seed, size, hot=0.34):
    """Rows where one transaction, one address and one asset-day are hot."""
    rng = random.Random(seed)
    defi, rollup = {address(3), address(7)}, {address(20)}
    rows = []
    for i in range(size):
        asset = "usdc" if rng.random() < hot else rng.choice(["usdt", "eurc", "pyusd"])
        day = dt.date(2025, 6, 1) + dt.timedelta(
            days=0 if rng.random() < hot else rng.randrange(5)
        )
        tx = "hot" if rng.random() < hot else f"t{rng.randrange(size)}"
        sender = address(1000 if rng.random() < hot else rng.randrange(60))
        receiver = address(rng.randrange(60))
        if rng.random() < 0.3:
            receiver = receiver.upper().replace("0X", "0x")
        touched = {sender.lower(), receiver.lower()}
        rows.append((asset, day, tx, sender, receiver, rng.randrange(10**6) / 4,
                     bool(touched & defi), bool(touched & rollup)))
    return rows


COLUMNS = (
    "asset string, date date, tx_hash string, `from` string, `to` string, amount double, "
    "is_defi_transaction boolean, is_rollup_transaction boolean"
)


def stats(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    out = {}
    for group, members in groups.items():
        volume = sum(r[5] for r in members)  # quarters add up exactly
        out[group] = (
            volume,
            len({r[2] for r in members}),
            len(members),
            volume / len(members),
            len({a.lower() for r in members for a in r[3:5]}),
            len({r[2] for r in members if r[6]}),
            len({r[2] for r in members if r[7]}),
        )
    return out
