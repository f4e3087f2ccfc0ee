"""Fixed values of the statements: event tables, selectors, topics, categories and weights, written out here
so that a wrong value in the library is not wrong on both sides."""

from __future__ import annotations

from typing import NamedTuple


class Spec(NamedTuple):
    protocol: str
    events: tuple[str, ...]
    tag: str


class Category(NamedTuple):
    feature: str
    idx: int
    sources: tuple[str, ...]


# Users of a protocol are senders of transactions with one of these events.
PROTOCOLS: dict[str, Spec] = {
    "aave_borrower": Spec(
        "aave",
        (
            "LendingPool_event_Borrow",
            "LendingPool_v2_event_Borrow",
        ),
        "AAVE borrower",
    ),
    "aave_depositor": Spec(
        "aave",
        (
            "LendingPool_event_Deposit",
            "LendingPool_v2_event_Deposit",
        ),
        "AAVE depositor",
    ),
    "aave_staker": Spec(
        "aave",
        (
            "StakedAave_event_Staked",
            "StakedTokenV2_event_Staked",
        ),
        "AAVE staker",
    ),
    "aave_flashloan_user": Spec(
        "aave",
        (
            "LendingPool_event_FlashLoan",
            "LendingPool_v2_event_FlashLoan",
        ),
        "AAVE flashloan user",
    ),
    "balancer_trader": Spec(
        "balancer",
        (
            "BPool_event_LOG_SWAP",
            "V2_Vault_event_Swap",
        ),
        "Balancer trader",
    ),
    "balancer_investor": Spec(
        "balancer",
        (
            "BPool_event_LOG_JOIN",
            "V2_Vault_event_PoolBalanceChanged",
        ),
        "Balancer investor",
    ),
    "balancer_flashloan_user": Spec(
        "balancer",
        (
            "V2_Vault_event_FlashLoan",
        ),
        "Balancer flashloan user",
    ),
    "compound_supplier": Spec(
        "compound",
        (
            "cBAT_event_Mint",
            "cCOMP_event_Mint",
            "cDAI_event_Mint",
            "cETH_event_Mint",
            "cLINK_event_Mint",
            "cSAI_event_Mint",
            "cTUSD_event_Mint",
            "cUNI_event_Mint",
            "cUSDT_event_Mint",
            "cWBTC2_event_Mint",
            "cWBTC_event_Mint",
            "cZRX_event_Mint",
        ),
        "Compound supplier",
    ),
    "compound_borrower": Spec(
        "compound",
        (
            "cBAT_event_Borrow",
            "cCOMP_event_Borrow",
            "cDAI_event_Borrow",
            "cETH_event_Borrow",
            "cLINK_event_Borrow",
            "cSAI_event_Borrow",
            "cTUSD_event_Borrow",
            "cUNI_event_Borrow",
            "cUSDT_event_Borrow",
            "cWBTC2_event_Borrow",
            "cWBTC_event_Borrow",
            "cZRX_event_Borrow",
        ),
        "Compound borrower",
    ),
    "dydx_user": Spec(
        "dydx",
        (
            "SoloMargin_event_LogDeposit",
            "PerpetualV1_event_LogDeposit",
        ),
        "Dydx user",
    ),
    "opyn_user": Spec(
        "opyn",
        (
            "oToken_event_VaultOpened",
            "oToken_event_Transfer",
            "oToken_event_Exercise",
        ),
        "Opyn user",
    ),
    "yearn_user": Spec(
        "yearn",
        (
            "YearnGovernance_call_voteAgainst",
            "YearnGovernance_call_voteFor",
            "YearnGovernance_event_OwnershipTransferred",
            "YearnGovernance_event_RewardAdded",
            "YearnGovernance_event_RewardPaid",
            "YearnGovernance_event_Staked",
            "YearnGovernance_event_Withdrawn",
        ),
        "Yearn user",
    ),
    "tornado_user": Spec(
        "tornado",
        (
            "TornadoCash_event_Deposit",
        ),
        "Tornado user",
    ),
    "eth2_depositor": Spec(
        "eth2",
        (
            "DepositContract_event_DepositEvent",
        ),
        "ETH2.0 depositor",
    ),
}
CURVE_TOPICS = (
    "0x8b3e96f2b889fa771c53c981b40daf005f63f637f1869f707052d15a3dd97140",
    "0x0bcc4c97732e47d9946f229edb95f5b6323f601300e4690de719993f3c371129",
)
ENS_HASH_REGISTERED = "Registrar0_event_HashRegistered"
ENS_REGISTERED = (
    "ETHRegistrarController_event_NameRegistered",
    "ETHRegistrarController2_event_NameRegistered",
    "ETHRegistrarController3_event_NameRegistered",
)
ENS_RENEWED = (
    "ETHRegistrarController_event_NameRenewed",
    "ETHRegistrarController2_event_NameRenewed",
    "ETHRegistrarController3_event_NameRenewed",
)
TORNADO_DEPOSIT = "0x13d98d13"
TORNADO_PROXY = "0x722122df12d4e14e13ac3b6895a86e84145b6967"
UNISWAP_V1_METHODS = (
    "0xf39b5b9b",
    "0x6b1d4db7",
    "0xad65d76d",
    "0x0b573638",
    "0xddf7e1a7",
    "0xb040d545",
    "0xf552d91b",
    "0xf3c0efe9",
    "0x013efd8b",
    "0x95e3c50b",
    "0x7237e031",
    "0xd4e4841d",
)
UNISWAP_V2_METHODS = (
    "0x7ff36ab5",
    "0xfb3bdb41",
    "0xb6f9de95",
    "0x8803dbee",
    "0x38ed1739",
    "0x5c11d795",
    "0x18cbafe5",
    "0x4a25d94a",
    "0x791ac947",
)
UNISWAP_V2_ROUTERS = (
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d",
    "0xf164fC0Ec4E93095b804a4795bBe1e041497b92a",
)
UNISWAP_V3_METHODS = (
    "0xc04b8d59",
    "0x414bf389",
    "0xdb3e2198",
    "0xf28c0498",
    "0xac9650d8",
)
UNISWAP_V3_ROUTER = "0x7a250d5630b4cf539739df2c5dacb4c659f2488d"
V2_POOL_TOPIC = "0x0d3648bd0f6ba80134a33ba9275ac585d9d315f0ad8355cddefde31afa28d0e9"
V3_POOL_TOPIC = "0x783cca1c0412dd0d695e784568c96da2e9c22ff989357a2e8b1d9b2b4e6b7118"
# Categories of addresses and the user tables they are made of.
CATEGORIES: dict[str, Category] = {
    "dex_trader": Category("Dex trader", 0, (
        "uniswap_trader",
        "balancer_trader",
        "curve_trader",
    )),
    "dex_liquidity_provider": Category("Dex liquitity provider", 1, (
        "balancer_investor",
    )),
    "decentralised_loaner": Category("Decentralised loaner", 2, (
        "aave_borrower",
        "compound_borrower",
        "dydx_user",
    )),
    "decentralised_loan_depositor": Category("Decentralised loan depositor", 3, (
        "aave_depositor",
        "compound_supplier",
    )),
    "decentralised_flashloan_user": Category("Decentralised loan depositor", 3, (
        "aave_flashloan_user",
        "balancer_flashloan_user",
    )),
    "decentralised_options_user": Category("Decentralised options user", 5, (
        "opyn_user",
    )),
    "decentralised_funds_user": Category("Decentralised funds user", 6, (
        "yearn_user",
    )),
}
# Sample data: event tables in the order the samples deal them out, and codes with a weight.
EVENT_PAIRS = sorted({(s.protocol, e) for s in PROTOCOLS.values() for e in s.events}) + [("ens", e) for e in (*ENS_REGISTERED, *ENS_RENEWED, ENS_HASH_REGISTERED)]
WEIGHTED = {
    "P001": (0, 1, 2, 3, 4, 5, 6),
    "P015": (0, 1, 2, 3, 4, 5, 6),
    "P112": (11, 12, 13),
    "P121": (10, 11),
    "P401": (1, 2, 3, 4, 5, 6),
    "P109": (1,),
    "P117": (4,),
    "P118": (5,),
    "P701": (0, 1, 2, 3, 5, 6),
    "P801": (0, 1, 2),
}
WEIGHTED_CODES = [(plots, idx) for plots, codes in WEIGHTED.items() for idx in codes]
