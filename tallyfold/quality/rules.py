"""Rules are data. What each kind counts as offending is defined in ``suite``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

ROW_KINDS = ("not_null", "matches_regex", "between", "in_set", "less_than")
SCHEMA_KINDS = ("column_exists", "of_type")
KEY_KINDS = ("unique", "exists_in")


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    name: str = ""
    severity: str = "critical"
    message: str = ""
    pattern: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    type_name: str | None = None
    limit: object = None
    reference_table: str | None = None
    reference_column: str | None = None

    def __post_init__(self):
        if self.kind not in ROW_KINDS + SCHEMA_KINDS + KEY_KINDS:
            raise ValueError(f"unknown rule kind {self.kind!r}")
        if self.severity not in ("critical", "warning"):
            raise ValueError(f"unknown severity {self.severity!r}")
        if not self.name:
            object.__setattr__(self, "name", f"{self.kind}_{self.column}")


# Rule type names in configuration files and the kinds they stand for.
CONFIG_KINDS = {
    "expect_column_to_exist": "column_exists",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_unique": "unique",
    "expect_column_values_to_match_regex": "matches_regex",
    "expect_column_values_to_be_of_type": "of_type",
    "expect_column_values_to_be_between": "between",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_be_less_than": "less_than",
    "expect_column_values_to_exist_in_other_table": "exists_in",
}
CONFIG_FIELDS = {
    "name": "name", "column": "column", "severity": "severity", "message": "message", "regex": "pattern",
    "min_value": "low", "max_value": "high", "values": "values", "value": "limit", "type_": "type_name",
    "reference_table": "reference_table", "reference_column": "reference_column",
}


def rules_from_config(records: Iterable[Mapping]) -> list[Rule]:
    """Rules from records as a configuration file holds them."""
    rules = []
    for record in records:
        fields = {CONFIG_FIELDS[k]: tuple(v) if k == "values" else v for k, v in record.items() if k != "type"}
        rules.append(Rule(CONFIG_KINDS[record["type"]], **fields))
    return rules


# The two suites used before loading ...
CRM_SUITE = [
    Rule("column_exists", "customer_id"),
    Rule("column_exists", "email"),
    Rule("not_null", "customer_id"),
    Rule("unique", "customer_id"),
    Rule("matches_regex", "email", pattern=r"[^@]+@[^@]+\.[^@]+"),
    Rule("of_type", "age", type_name="int64"),
    Rule("between", "age", low=18, high=100),
]
TRANSACTION_SUITE = [
    Rule("column_exists", "transaction_id"),
    Rule("column_exists", "customer_id"),
    Rule("column_exists", "amount"),
    Rule("not_null", "transaction_id"),
    Rule("unique", "transaction_id"),
    Rule("of_type", "amount", type_name="float64"),
    Rule("between", "amount", low=0.0, high=100000.0),
    Rule("matches_regex", "currency", pattern=r"^[A-Z]{3}$"),
    Rule("in_set", "status", values=("SUCCESS", "FAILED", "PENDING")),
]

# ... and the three suites of the rule configuration, with severities and messages.
CONFIGURED_SUITES = {
    "customers": [
        Rule("not_null", "customer_id", "no_null_customer_id", "critical",
             "Le champ customer_id ne doit pas contenir de valeurs nulles."),
        Rule("unique", "customer_id", "unique_customer_id", "critical",
             "Les identifiants clients doivent être uniques."),
        Rule("matches_regex", "email", "valid_email_format", "warning",
             "Certaines adresses email ne respectent pas le format valide.", pattern=r"^[\w\.-]+@[\w\.-]+\.\w+$"),
        Rule("between", "age", "valid_age_range", "warning",
             "Âge du client en dehors de la plage autorisée (18-99).", low=18, high=99),
    ],
    "transactions": [
        Rule("not_null", "transaction_id", "no_null_transaction_id", "critical",
             "Le champ transaction_id ne doit pas contenir de valeurs nulles."),
        Rule("between", "amount", "positive_amount", "critical",
             "Montant de transaction invalide (négatif ou supérieur à 100000).", low=0, high=100000),
        Rule("in_set", "currency", "valid_currency", "warning",
             "Certaines devises ne sont pas reconnues.", values=("USD", "EUR", "MAD")),
        Rule("less_than", "timestamp", "timestamp_not_future", "warning",
             "Certaines transactions datent du futur (erreur horodatage).", limit="now"),
    ],
    "joins": [
        Rule("exists_in", "customer_id", "foreign_key_customer_exists", "critical",
             "Des transactions contiennent un customer_id inexistant dans la base CRM.",
             reference_table="customers", reference_column="customer_id"),
    ],
}
