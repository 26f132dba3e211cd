"""Published constants the results depend on.

Everything in this file is data, kept together as plain text: contract
addresses, the event signature and the default block range. Addresses keep
their checksum spelling; they are lower-cased where they become a table.
"""

# Fixed value: signature topic of the ERC-20 event
# Transfer(address indexed from, address indexed to, uint256 value).
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"

# Token registry (asset, contract, decimals, symbol, enabled).
TOKENS = [
    ("usdc", "0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48", 6, "USDC", True),
    ("usdt", "0xdAC17F958D2ee523a2206206994597C13D831ec7", 6, "USDT", True),
    ("pyusd", "0x6c3ea9036406852006290770BEdFcAbA0e23A0e8", 6, "PYUSD", True),
    ("dai", "0x6B175474E89094C44Da98b954EedeAC495271d0F", 18, "DAI", False),
    ("eurc", "0x1aBaEA1f7C830bD89Acc67eC4af516284b1bC33c", 6, "EURC", True),
]

# Contracts whose contact marks a transfer as a DeFi transfer.
DEFI_CONTRACTS = {
    "aave": [
        "0x7d2768dE32b0b80b7a3454c06BdAc94A69DDc7A9",
        "0x87870bca3f3fd6335c3f4ce8392d69350b4fa4e2",
    ],
    "compound": ["0x39AA39c021dfbaE8faC545936693aC917d5E7563"],
    "uniswap": [
        "0xE592427A0AEce92De3Edee1F18E0157C05861564",
        "0x7a250d5630B4cF539739dF2C5dAcb4c659F2488D",
    ],
    "lido": [
        "0xAE7ab96520DE3A18E5e111B5EaAb095312d7FE84",
        "0xdc24316b9ae028f1497c275eb9192a3ea0f67022",
    ],
    "curve": [
        "0xbebc44782c7db0a1a60cb6fe97d0b483032ff1c7",
        "0xa2b47e3d5c8c5c5c5c5c5c5c5c5c5c5c5c5c5c5c",
    ],
    "dydx": ["0x1e0447b19bb6ecfdae1e4ae1694b0c3659614e4e"],
}

# Contracts whose contact marks a transfer as a rollup transfer.
ROLLUP_CONTRACTS = {
    "arbitrum": [
        "0x8315177aB297bA92A06054cE80a67Ed4DBd7ed3a",
        "0xC1Ebd02f738644983b6C4B2d440b8e77DdE276Bd",
        "0x0B9857ae2D4A3DBe74ffE1d7DF045bb7F96E4840",
        "0xD4B80C3D7240325D18E645B49e6535A3Bf95cc58",
        "0x912CE59144191C1204E64559FE8253a0e49E6548",
        "0xc4448b71118c9071Bcb9734A0EAc55D18A153949",
    ],
    "base": ["0x3154Cf16ccdb4C6d922629664174b904d80F2C35"],
    "optimism": ["0x99C9fc46f92E8a1c0deC1b1747d010903E884bE1"],
    "unichain": ["0x81014f44b0a345033bb2b3b21c7a1a308b35feea"],
}

# Default inclusive block range and blocks per chunk.
START_BLOCK = 22700000
END_BLOCK = 22720000
CHUNK_BLOCKS = 10000

# The metrics that are charted, in chart order.
CHART_METRICS = [
    "total_volume",
    "transaction_count",
    "different_addresses",
    "defi_transaction_count",
    "rollup_transaction_count",
]
