"""Bank source systems derived from the star-schema test tables.

Pure column arithmetic on each table's own key ``k``: every defect the warehouse
must handle is planted by a rule, so its effect can be recomputed in plain SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Planted-defect periods and code lists of the derived sources.
STATES = ["NSW", "VIC", "QLD", "SA", "WA", "TAS", "NT", "ACT"]
ACCOUNT_TYPES = ["TRANSACTION", "SAVINGS", "CREDIT", "HOME_LOAN"]
CHANNELS = ["MOBILE", "WEB", "ATM", "BRANCH", "CARD"]
TRANSACTION_TYPES = ["TRANSFER", "PURCHASE", "WITHDRAWAL", "DEPOSIT", "BILL_PAYMENT"]
MERCHANTS = [
    "GROCERIES", "FUEL", "DINING", "RETAIL", "TRANSPORT", "HEALTH",
    "ENTERTAINMENT", "UTILITIES", "INTERNAL", "CASH", "BILLERS",
]
DEVICES = ["MOBILE", "TABLET", "DESKTOP"]
PREFERRED_CHANNELS = ["MOBILE", "WEB", "BRANCH", "CALL_CENTRE"]
CASE_TYPES = [
    "CARD_ISSUE", "ACCOUNT_QUERY", "TRANSACTION_DISPUTE",
    "LOGIN_PROBLEM", "LOAN_ENQUIRY", "GENERAL_ENQUIRY",
]
PRIORITIES = ["LOW", "MEDIUM", "HIGH"]
SEGMENTS = {"AUTOMOBILE": "PREMIUM", "BUILDING": "BUSINESS", "MACHINERY": "BUSINESS"}
TX_STATUS = {"F": "ACCEPTED", "O": "DECLINED", "P": "REVERSED"}
ACTIVITY_TYPES = {
    "click": "VIEW_ACCOUNT", "view": "VIEW_TRANSACTION", "purchase": "PAY_BILL",
    "signup": "UPDATE_PROFILE", "error": "LOGIN",
}

ID_DIGITS = 12

# Declared, so that opening a table costs no footer scan.
TEST_TABLES = {
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prefixed(prefix: str, k: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(k.cast("string"), ID_DIGITS, "0"))


def pick(values: list[str], k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values)).cast("int") + 1)


def chosen(mapping: dict[str, str], c: Column, default: str) -> Column:
    out = None
    for code, value in mapping.items():
        out = F.when(c == code, value) if out is None else out.when(c == code, value)
    return out.otherwise(default)


def every(k: Column, period: int, rest: int = 0) -> Column:
    return (k % period) == rest


def days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _person(k: Column, name: Column) -> dict[str, Column]:
    """Name, birth date and contact details as the core system holds them."""
    parts = F.split(name, "#")
    born = F.when((k % 120).isin(1, 3), k - 1).otherwise(k)
    mail = F.when(every(k, 60, 1), k - 1).otherwise(k)
    own_last = F.element_at(parts, 2)
    namesake_last = F.lpad((k - 1).cast("string"), 9, "0")
    return {
        "first_name": F.element_at(parts, 1),
        "last_name": F.when(every(k, 40, 1), namesake_last).otherwise(own_last),
        "date_of_birth": days_after("1950-01-01", (born * 37) % 20000),
        "email": F.concat(F.lit("user"), mail.cast("string"), F.lit("@example.test")),
        "phone": F.concat(F.lit("04"), F.lpad(k.cast("string"), 8, "0")),
    }


def _international(phone: Column) -> Column:
    parts = [F.substring(phone, 2, 3), F.substring(phone, 5, 3), F.substring(phone, 8, 30)]
    return F.concat_ws(" ", F.lit("+61"), *parts)


def _profile(k: Column, name: Column, rule: dict[str, int]) -> dict[str, Column]:
    """A second system's copy of a person: some facts missing, some wrong, formats differ."""
    core = _person(k, name)
    phone = F.when(every(k, 120, 2), _person(k + 1, name)["phone"]).otherwise(core["phone"])
    return {
        "first_name": F.when(
            every(k, rule["padded"]), F.concat(F.lit("  "), core["first_name"], F.lit(" "))
        ).otherwise(core["first_name"]),
        "last_name": core["last_name"],
        "date_of_birth": F.when(every(k, rule["no_dob"]), F.lit(None).cast("date"))
        .when(every(k, rule["wrong_dob"]), F.date_add(core["date_of_birth"], 1))
        .otherwise(core["date_of_birth"]),
        "email": F.when(every(k, rule["no_email"]), F.lit(None).cast("string"))
        .when(every(k, rule["upper_email"]), F.upper(core["email"]))
        .otherwise(core["email"]),
        "phone": F.when(every(k, rule["no_phone"]), F.lit(None).cast("string"))
        .when(every(k, rule["intl_phone"]), _international(phone))
        .otherwise(phone),
    }


PAYMENT_RULE = {
    "no_dob": 11, "wrong_dob": 13, "no_email": 17, "no_phone": 19,
    "upper_email": 3, "padded": 7, "intl_phone": 5,
}
DIGITAL_RULE = {
    "no_dob": 13, "wrong_dob": 17, "no_email": 19, "no_phone": 11,
    "upper_email": 4, "padded": 9, "intl_phone": 6,
}


def _select(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()])


def core_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return _select(
        customer,
        {
            "customer_id": prefixed("C", k),
            **_person(k, F.col("c_name")),
            "address_line": F.concat(k.cast("string"), F.lit(" Synthetic Avenue")),
            "suburb": F.concat(F.lit("Suburb "), F.col("c_nationkey").cast("string")),
            "state": F.when(every(k, 23), F.lit(None).cast("string")).otherwise(pick(STATES, k)),
            "postcode": (F.col("c_nationkey") + 2000).cast("string"),
            "customer_segment": chosen(SEGMENTS, F.col("c_mktsegment"), "RETAIL"),
            "created_date": days_after("2018-01-01", k % 1500),
            "status": F.when(every(k, 23, 5), "INACTIVE").otherwise("ACTIVE"),
        },
    )


def _account_numbers(customer: DataFrame) -> DataFrame:
    """Two accounts for even customers, one for odd ones."""
    k = F.col("c_custkey")
    owned = F.when(every(k, 2), F.array(k * 2, k * 2 + 1)).otherwise(F.array(k * 2))
    return customer.select("c_custkey", "c_acctbal", F.explode(owned).alias("a"))


def core_accounts(customer: DataFrame) -> DataFrame:
    a = F.col("a")
    return _select(
        _account_numbers(customer),
        {
            "account_id": prefixed("A", a),
            "account_type": pick(ACCOUNT_TYPES, a),
            "product_name": F.concat(F.lit("Synthetic "), pick(ACCOUNT_TYPES, a)),
            "open_date": days_after("2018-01-01", a % 1500),
            "balance": F.col("c_acctbal").cast("decimal(15,2)"),
            "currency": F.lit("AUD"),
            "status": F.when(every(a, 29), "CLOSED").otherwise("ACTIVE"),
        },
    )


def account_owners(customer: DataFrame) -> DataFrame:
    return _select(
        _account_numbers(customer),
        {
            "customer_id": prefixed("C", F.col("c_custkey")),
            "account_id": prefixed("A", F.col("a")),
            "ownership_type": F.lit("PRIMARY"),
            "relationship_from": days_after("2018-01-01", F.col("a") % 1500),
        },
    )


def payment_customers(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    registered = days_after("2019-01-01", k % 1000)
    profiles = _select(
        customer.where(k % 20 != 4),
        {
            "payment_customer_id": prefixed("P", k),
            **_profile(k, F.col("c_name"), PAYMENT_RULE),
            "registered_date": registered,
        },
    )
    twin = _person(k, F.col("c_name"))
    twins = _select(
        customer.where(every(k, 121)),
        {
            "payment_customer_id": prefixed("X", k),
            "first_name": twin["first_name"],
            "last_name": twin["last_name"],
            "date_of_birth": F.lit(None).cast("date"),
            "email": twin["email"],
            "phone": F.lit(None).cast("string"),
            "registered_date": registered,
        },
    )
    parts = F.split("s_name", "#")
    merchants = _select(
        supplier,
        {
            "payment_customer_id": prefixed("Y", s),
            "first_name": F.element_at(parts, 1),
            "last_name": F.element_at(parts, 2),
            "date_of_birth": F.lit("1980-01-01").cast("date"),
            "email": F.lit(None).cast("string"),
            "phone": F.lit(None).cast("string"),
            "registered_date": days_after("2019-01-01", s % 1000),
        },
    )
    return profiles.unionByName(twins).unionByName(merchants)


def digital_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return _select(
        customer.where(k % 15 != 3),
        {
            "digital_customer_id": prefixed("D", k),
            **_profile(k, F.col("c_name"), DIGITAL_RULE),
            "signup_date": days_after("2020-01-01", k % 900),
            "preferred_channel": pick(PREFERRED_CHANNELS, k),
        },
    )


def payment_transactions(orders: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return _select(
        orders,
        {
            "transaction_id": prefixed("T", k),
            "source_transaction_ref": prefixed("BREF-", F.when(every(k, 97, 1), k - 1).otherwise(k)),
            "payment_customer_id": F.when(every(k, 223), "PUNKNOWN").otherwise(prefixed("P", c)),
            "account_id": F.when(every(k, 211), "AUNKNOWN").otherwise(prefixed("A", c * 2)),
            "transaction_ts": F.col("o_orderdate")
            + F.make_dt_interval(mins=(k % 1440).cast("int")),
            "transaction_type": pick(TRANSACTION_TYPES, k),
            "amount": F.col("o_totalprice").cast("decimal(15,2)"),
            "currency": F.lit("AUD"),
            "channel": pick(CHANNELS, k),
            "merchant_category": pick(MERCHANTS, k),
            "status": chosen(TX_STATUS, F.col("o_orderstatus"), "DECLINED"),
        },
    )


def _digital_reference(events_key: Column) -> Column:
    return F.when(every(events_key, 499), "DUNKNOWN").otherwise(prefixed("D", F.col("user_id")))


def digital_activity(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    return _select(
        events,
        {
            "activity_id": prefixed("ACT", k),
            "digital_customer_id": _digital_reference(k),
            "activity_ts": F.col("ts"),
            "channel": F.when(every(k, 2), "MOBILE").otherwise("WEB"),
            "activity_type": chosen(ACTIVITY_TYPES, F.col("event_type"), "TRANSFER_FUNDS"),
            "device_type": pick(DEVICES, k),
            "session_minutes": F.col("value").cast("decimal(8,2)"),
        },
    )


def service_cases(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    still_open = (k % 5).isin(0, 1)
    return _select(
        events.where(F.col("event_type") == "error"),
        {
            "case_id": prefixed("SC", k),
            "digital_customer_id": _digital_reference(k),
            "opened_ts": F.col("ts"),
            "closed_ts": F.when(
                ~still_open, F.col("ts") + F.make_dt_interval(hours=(k % 5).cast("int"))
            ),
            "case_type": pick(CASE_TYPES, k),
            "priority": pick(PRIORITIES, k),
            "status": F.when(every(k, 5), "OPEN").when(every(k, 5, 1), "IN_PROGRESS").otherwise("CLOSED"),
        },
    )


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table to derive sources from. A million customers are a few MB and often one row group,
    so one task would derive, hash and sort all their profiles, accounts and lookup keys: their
    short raw rows are dealt out first."""
    table = read_table(spark, sf_dir, name)
    return table.repartition("c_custkey") if name == "customer" else table


class Sources(Mapping[str, DataFrame]):
    """Source tables by name, each derived when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, derived: Mapping[str, tuple]):
        self._read = lambda name: spread_table(spark, sf_dir, name)
        self._derived = derived
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            derive, *inputs = self._derived[name]
            self._frames[name] = derive(*map(self._read, inputs))
        return self._frames[name]

    def __iter__(self):
        return iter(self._derived)

    def __len__(self) -> int:
        return len(self._derived)


def bank_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The eight source tables of the strict contract."""
    return Sources(
        spark,
        sf_dir,
        {
            "customer": (core_customers, "customer"),
            "account": (core_accounts, "customer"),
            "customer_account": (account_owners, "customer"),
            "payment_customer": (payment_customers, "customer", "supplier"),
            "payment_transaction": (payment_transactions, "orders"),
            "digital_customer": (digital_customers, "customer"),
            "activity": (digital_activity, "events"),
            "service_case": (service_cases, "events"),
        },
    )
