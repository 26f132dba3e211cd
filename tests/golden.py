"""The hand-made blocks of FIXTURES.md section 3, landed as JSON lines."""

import json

from ledgerline.fixed_values import DEFI_CONTRACTS, ROLLUP_CONTRACTS, TOKENS, TRANSFER_TOPIC

T = TRANSFER_TOPIC
X, Y, Z = "0x" + "11" * 20, "0x" + "22" * 20, "0x" + "00" * 20
AAVE_V2, AAVE_V3 = (a.lower() for a in DEFI_CONTRACTS["aave"])
BASE_BRIDGE = ROLLUP_CONTRACTS["base"][0].lower()
ARB_BRIDGE = ROLLUP_CONTRACTS["arbitrum"][0].lower()
TOKEN = {row[0]: row[1] for row in TOKENS}
USDC = TOKEN["usdc"].lower()


def topic(address):
    return "0x" + "0" * 24 + address[2:]


def log(token, topics, data):
    return {"address": token, "topics": topics, "data": data}


def transfer(token, sender, receiver, data, *more):
    return log(token, [T, topic(sender), topic(receiver), *more], data)


def receipt(tx, *logs):
    return {"transactionHash": tx, "logs": list(logs), "status": "0x1"}


HEADERS = [
    {"block_number": 22700000, "timestamp": "0x684cbb74", "miner": "ignored"},
    {"block_number": 22700001, "timestamp": "0x684cbb80"},
    {"block_number": 22700002, "timestamp": None},
    {"block_number": 22700003, "timestamp": "0x684cbb8c"},
]

RECEIPTS = [
    {
        "block_number": 22700000,
        "receipts": [
            receipt(
                "A",
                transfer(USDC, X, Y, hex(1_000_000)),
                transfer(USDC, Y, AAVE_V2, "0x2625a0"),
            ),
            receipt(
                "B",
                transfer(TOKEN["usdc"], X, X, "0x"),
                transfer(TOKEN["usdt"].lower(), X, BASE_BRIDGE, "0xe8d4a51000"),
            ),
            receipt(
                "C",
                log(USDC, [T, topic(X)], "0x1"),
                log(USDC, ["0x" + "ab" * 32, topic(X), topic(Y)], "0x1"),
                log(USDC, [], "0x1"),
                transfer("0x" + "99" * 20, X, Y, "0x1"),
                {"topics": [T, topic(X), topic(Y)], "data": "0x1"},
                {"address": USDC, "data": "0x1"},
            ),
        ],
    },
    {
        "block_number": 22700001,
        "receipts": [
            receipt(
                "D",
                transfer(USDC, AAVE_V3, ARB_BRIDGE, hex(3_000_000)),
                transfer(USDC, Z, X, "0x6ea050", topic(Y)),
            ),
            receipt("E", transfer(TOKEN["eurc"].lower(), X, Y, hex(2**70))),
            receipt("F", log(USDC, [T.upper(), topic(X), topic(Y)], "0x1")),
            None,
            {"transactionHash": "G"},
        ],
    },
    {"block_number": 22700002, "receipts": [receipt("H", transfer(USDC, X, Y, "0x1"))]},
    {"block_number": 22700003, "receipts": None},
]

BIG = 1180591620717411.25

# block, tx_hash, asset, from, to, amount, defi, rollup
TRANSFERS = [
    (22700000, "A", "usdc", X, Y, 1.0, False, False),
    (22700000, "A", "usdc", Y, AAVE_V2, 2.5, True, False),
    (22700000, "B", "usdc", X, X, 0.0, False, False),
    (22700000, "B", "usdt", X, BASE_BRIDGE, 1000000.0, False, True),
    (22700001, "D", "usdc", AAVE_V3, ARB_BRIDGE, 3.0, True, True),
    (22700001, "D", "usdc", Z, X, 7.25, False, False),
    (22700001, "E", "eurc", X, Y, BIG, False, False),
]

# asset, date, volume, transactions, transfers, average, addresses, defi, rollup
DAILY = [
    ("eurc", "2025-06-14", BIG, 1, 1, BIG, 2, 0, 0),
    ("usdc", "2025-06-13", 3.5, 2, 3, 3.5 / 3, 3, 1, 0),
    ("usdc", "2025-06-14", 10.25, 1, 2, 5.125, 4, 1, 1),
    ("usdt", "2025-06-13", 1000000.0, 1, 1, 1000000.0, 2, 0, 1),
]


def land(folder, name, records):
    path = folder / name
    path.mkdir(parents=True, exist_ok=True)
    half = (len(records) + 1) // 2
    for i, part in enumerate((records[:half], records[half:])):
        text = "".join(json.dumps(r) + "\n" for r in part)
        (path / f"{i}.json").write_text(text)
    return str(path)


def blocks():
    """Header time and receipts of a block in one record."""
    time = {h["block_number"]: h["timestamp"] for h in HEADERS}
    return [{**r, "timestamp": time[r["block_number"]]} for r in RECEIPTS]
