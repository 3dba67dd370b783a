"""The ordered business rules an order event must pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import EMAIL_PATTERN, PRODUCT_PATTERN, is_blank, matches

# Required fields in the order they are judged, the channels,
# the tolerated gap and the widest values the landing table takes.
REQUIRED_FIELDS = (
    ("order_id", "order_id"),
    ("customer_email", "customer_email"),
    ("channel", "channel"),
    ("product_ref", "product_ref"),
    ("quantity", "quantity_text"),
    ("unit_price_eur", "unit_price_text"),
    ("amount_eur", "amount_text"),
    ("order_timestamp", "timestamp_text"),
)
CHANNELS = ("web", "app", "store")
AMOUNT_TOLERANCE = 0.05
MONEY = "decimal(10,2)"
MAX_INTEGER = 2147483647
MAX_LENGTHS = (
    ("order_id", 50),
    ("customer_email", 255),
    ("store_code", 10),
    ("product_ref", 30),
)


@dataclass(frozen=True)
class Rule:
    code: str
    fails: Column
    message: Column


def _rule(code: str, fails: Column, message: str | Column) -> Rule:
    return Rule(code, fails, F.lit(message) if isinstance(message, str) else message)


def expected_amount() -> Column:
    return F.round(F.col("quantity_number") * F.col("unit_price"), 2)


def amount_mismatch(exact: bool = False, tolerance: float = AMOUNT_TOLERANCE) -> Column:
    """Gap between stated and computed amount.

    Binary floating point by default, where 59.80 and 59.85 are more than five
    cents apart; ``exact`` judges the same gap on decimals.
    """
    if not exact:
        return F.abs(expected_amount() - F.col("amount")) > tolerance
    computed = F.round(F.col("quantity_number").try_cast("decimal(18,4)")
                       * F.col("unit_price").try_cast("decimal(18,4)"), 2)
    return F.abs(computed - F.col("amount").try_cast("decimal(18,4)")) > F.lit(str(tolerance)).cast("decimal(6,4)")


def order_rules(exact: bool = False, max_lengths: tuple = MAX_LENGTHS) -> list[Rule]:
    """All rules in judging order; the first one that fails names the reject.

    Type faults are judged at the point where an untyped reader would stumble
    over them: number faults after the patterns, storage faults last. The order
    and the messages are fixed values that other systems read.
    """
    rules = [_rule("bad_json", F.col("bad_json"), "JSON illisible")]
    rules += [
        _rule(f"missing_{field}", is_blank(F.col(column)), f"Champ obligatoire manquant: {field}")
        for field, column in REQUIRED_FIELDS
    ]
    rules += [
        _rule("email", ~matches(F.col("customer_email"), EMAIL_PATTERN), "Email client invalide"),
        _rule("product", ~matches(F.col("product_ref"), PRODUCT_PATTERN), "Reference produit invalide"),
        _rule("unit_price_type", F.col("unit_price").isNull(), "Type invalide: unit_price_eur"),
        _rule("amount_type", F.col("amount").isNull(), "Type invalide: amount_eur"),
        _rule("quantity_type", F.col("quantity_number").isNull(), "Type invalide: quantity"),
        _rule("quantity", F.col("quantity_number") <= 0, "Quantite doit etre positive"),
        _rule("price", (F.col("unit_price") <= 0) | (F.col("amount") <= 0), "Montants doivent etre positifs"),
        _rule(
            "amount",
            amount_mismatch(exact),
            F.concat(F.lit("Incoherence montant: attendu "), expected_amount().cast("string"),
                     F.lit(", recu "), F.col("amount").cast("string")),
        ),
        _rule("channel", ~F.col("channel").isin(*CHANNELS), F.concat(F.lit("Canal inconnu: "), F.col("channel"))),
        _rule("store", (F.col("channel") == "store") & is_blank(F.col("store_code")),
              "store_code obligatoire pour le canal store"),
        _rule("quantity_integer", (F.col("quantity_number") != F.floor("quantity_number"))
              | (F.col("quantity_number") > MAX_INTEGER), "Type invalide: quantity"),
        _rule("timestamp", F.col("order_timestamp").isNull(), "Type invalide: order_timestamp"),
        _rule("money_range", F.col("unit_price").try_cast(MONEY).isNull() | F.col("amount").try_cast(MONEY).isNull(),
              "Montant hors limites"),
    ]
    rules += [
        _rule(f"length_{column}", F.length(column) > limit, f"Valeur trop longue: {column}")
        for column, limit in max_lengths
    ]
    return rules


def judge(parsed: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add ``error_code``: NULL for a valid event, else the first failing rule.

    The code is generated as a one-element list, which computes it once per
    row; as a projection the whole chain would be copied into every filter.
    """
    rules = order_rules() if rules is None else rules
    code = F.coalesce(*[F.when(r.fails, F.lit(r.code)) for r in rules])
    return parsed.select("*", F.explode(F.array(code)).alias("error_code"))


def error_message(rules: list[Rule] | None = None) -> Column:
    """The reject reason in words, from ``error_code``."""
    rules = order_rules() if rules is None else rules
    return F.coalesce(*[F.when(F.col("error_code") == r.code, r.message) for r in rules])


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("error_code").isNull())


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("error_code").isNotNull())
