"""Data contracts: one declaration per table that yields the schema, the defaults, the rules and the masks."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SIMPLE_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    pii: bool = False
    mask: str | None = None
    default: str | int | bool | None = None
    allowed: tuple[str, ...] = ()
    precision: int = 10
    scale: int = 2
    description: str = ""

    def spark_type(self) -> T.DataType:
        return T.DecimalType(self.precision, self.scale) if self.type == "decimal" else SIMPLE_TYPES[self.type]


@dataclass(frozen=True)
class Rule:
    """One quality rule. ``kind``: not_null, uniqueness, accepted_values, regex, comparison, referential_integrity."""

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    expression: str = ""
    pattern: str = ""
    values: tuple[str, ...] = ()
    target_table: str = ""
    target_column: str = ""
    severity: str = "critical"


@dataclass(frozen=True)
class Contract:
    table: str
    source_system: str
    freshness_hours: float
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    source_table: str = ""
    owner: str = ""
    keys: tuple[str, ...] = field(default=())

    def schema(self) -> T.StructType:
        out = T.StructType()
        for f in self.fields:
            meta = {"pii": f.pii, "mask": f.mask or "", "description": f.description}
            out.add(T.StructField(f.name, f.spark_type(), f.nullable, meta))
        return out

    def all_rules(self) -> tuple[Rule, ...]:
        """Declared rules plus those implied by ``nullable: false`` and the allowed values."""
        implied = [Rule(f"{f.name}_not_null", "not_null", (f.name,)) for f in self.fields if not f.nullable]
        implied += [
            Rule(f"{f.name}_allowed", "accepted_values", (f.name,), values=f.allowed) for f in self.fields if f.allowed
        ]
        return tuple(implied) + self.rules


def _req(name: str, type_: str, **more) -> Field:
    return Field(name, type_, nullable=False, **more)


def _money(name: str, precision: int, **more) -> Field:
    return Field(name, "decimal", nullable=False, precision=precision, scale=2, **more)


_STAMPS = (_req("created_at", "timestamp"), _req("updated_at", "timestamp"))

# Table layouts, allowed values, patterns and service levels of the retail sources.
SEGMENTS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
ORDER_STATUSES = ("PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
PAYMENT_METHODS = ("CREDIT_CARD", "DEBIT_CARD", "PIX", "BOLETO", "WALLET")
STORE_TYPES = ("FLAGSHIP", "STANDARD", "OUTLET", "POPUP", "WAREHOUSE")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

CUSTOMERS = Contract(
    "customers",
    "oracle_erp",
    24,
    (
        _req("customer_id", "string"),
        _req("first_name", "string", pii=True, mask="partial"),
        _req("last_name", "string", pii=True, mask="partial"),
        Field("email", "string", pii=True, mask="hash"),
        Field("phone", "string", pii=True, mask="partial"),
        Field("address_line1", "string", pii=True),
        Field("city", "string"),
        Field("state", "string"),
        Field("postal_code", "string"),
        _req("country_code", "string", default="BR"),
        Field("customer_segment", "string", allowed=SEGMENTS),
        _req("registration_date", "date"),
        _req("is_active", "boolean", default=True),
        *_STAMPS,
    ),
    (
        Rule("customer_id_unique", "uniqueness", ("customer_id",)),
        Rule("email_format_valid", "regex", ("email",), pattern=EMAIL_PATTERN, severity="warning"),
        Rule("registration_not_future", "comparison", expression="registration_date <= current_date()"),
    ),
    source_table="CRM.CUSTOMERS",
    owner="crm-team@enterprise.com",
    keys=("customer_id",),
)

PRODUCTS = Contract(
    "products",
    "oracle_erp",
    6,
    (
        _req("product_id", "string"),
        _req("product_name", "string"),
        _req("category_id", "string"),
        Field("category_name", "string"),
        Field("subcategory_name", "string"),
        Field("brand", "string"),
        _money("unit_price", 10),
        _money("unit_cost", 10),
        _req("stock_quantity", "integer", default=0),
        _req("is_active", "boolean", default=True),
        *_STAMPS,
    ),
    (
        Rule("product_id_unique", "uniqueness", ("product_id",)),
        Rule("price_positive", "comparison", expression="unit_price > 0"),
        Rule("cost_less_than_price", "comparison", expression="unit_cost <= unit_price", severity="warning"),
    ),
    source_table="INV.PRODUCTS",
    owner="inventory-team@enterprise.com",
    keys=("product_id",),
)

ORDERS = Contract(
    "orders",
    "sqlserver_ecommerce",
    1,
    (
        _req("order_id", "string"),
        _req("customer_id", "string"),
        _req("order_date", "timestamp"),
        _req("order_status", "string", allowed=ORDER_STATUSES),
        Field("shipping_address", "string", pii=True, mask="full"),
        _req("payment_method", "string", allowed=PAYMENT_METHODS),
        _money("subtotal", 12),
        _money("discount_amount", 10, default=0),
        _money("shipping_cost", 10, default=0),
        _money("total_amount", 12),
        *_STAMPS,
    ),
    (
        Rule("order_id_unique", "uniqueness", ("order_id",)),
        Rule(
            "total_calculation",
            "comparison",
            expression="abs(total_amount - (subtotal - discount_amount + shipping_cost)) < 0.01",
        ),
        Rule(
            "customer_exists",
            "referential_integrity",
            ("customer_id",),
            target_table="customers",
            target_column="customer_id",
        ),
    ),
    source_table="dbo.Orders",
    owner="ecommerce-team@enterprise.com",
    keys=("order_id",),
)

ORDER_ITEMS = Contract(
    "order_items",
    "sqlserver_ecommerce",
    1,
    (
        _req("order_item_id", "string"),
        _req("order_id", "string"),
        _req("product_id", "string"),
        _req("quantity", "integer"),
        _money("unit_price", 10),
        _money("discount_percent", 5, default=0),
        _money("line_total", 12),
        _req("created_at", "timestamp"),
    ),
    (
        Rule("order_item_id_unique", "uniqueness", ("order_item_id",)),
        Rule("quantity_positive", "comparison", expression="quantity > 0"),
        Rule(
            "line_total_calculation",
            "comparison",
            expression="abs(line_total - (quantity * unit_price * (1 - discount_percent/100))) < 0.01",
            severity="warning",
        ),
    ),
    source_table="dbo.OrderItems",
    owner="ecommerce-team@enterprise.com",
    keys=("order_item_id",),
)

STORES = Contract(
    "stores",
    "oracle_erp",
    24,
    (
        _req("store_id", "string"),
        _req("store_name", "string"),
        _req("store_type", "string", allowed=STORE_TYPES),
        _req("region", "string"),
        _req("city", "string"),
        _req("state", "string"),
        Field("manager_name", "string", pii=True),
        _req("open_date", "date"),
        _req("is_active", "boolean", default=True),
        *_STAMPS,
    ),
    (Rule("store_id_unique", "uniqueness", ("store_id",)),),
    source_table="POS.STORES",
    owner="operations-team@enterprise.com",
    keys=("store_id",),
)

RETAIL = {c.table: c for c in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, STORES)}


def load_yaml(path: str | Path) -> dict[str, Contract]:
    """Contracts from a YAML file with ``schema.fields`` and ``quality_rules`` per table."""
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - depends on the installation
        raise RuntimeError("reading contract files needs PyYAML") from error

    document = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    out = {}
    for table, body in document.items():
        fields = tuple(
            Field(
                f["name"],
                f["type"],
                nullable=f.get("nullable", True),
                pii=f.get("pii", False),
                mask=f.get("masking_strategy"),
                default=f.get("default"),
                allowed=tuple(f.get("allowed_values", ())),
                precision=f.get("precision", 10),
                scale=f.get("scale", 2),
                description=f.get("description", ""),
            )
            for f in body["schema"]["fields"]
        )
        rules = tuple(
            Rule(
                r["rule"],
                r["type"],
                tuple(r.get("columns") or ([r["target_column"]] if "target_column" in r else [])),
                expression=r.get("expression", ""),
                pattern=r.get("pattern", ""),
                target_table=r.get("target_table", ""),
                target_column=r.get("target_column", ""),
                severity=r.get("severity", "critical"),
            )
            for r in body.get("quality_rules", ())
        )
        unique = [r for r in rules if r.kind == "uniqueness"]
        out[table] = Contract(
            table,
            body.get("source_system", ""),
            float(body.get("sla", {}).get("freshness_hours", 24)),
            fields,
            rules,
            source_table=body.get("source_table", ""),
            owner=body.get("owner", ""),
            keys=unique[0].columns if unique else (),
        )
    return out


def fields_table(spark: SparkSession, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """Contract fields as rows; also usable as the expected side of a drift check."""
    rows = [
        (c.table, f.name, f.spark_type().simpleString(), f.nullable, f.pii, f.mask)
        for c in (contracts or RETAIL).values()
        for f in c.fields
    ]
    schema = "table_name string, column_name string, data_type string, nullable boolean, pii boolean, mask string"
    return spark.createDataFrame(rows, schema)


def rules_table(spark: SparkSession, contracts: dict[str, Contract] | None = None) -> DataFrame:
    rows = [
        (c.table, r.name, r.kind, list(r.columns), r.expression or r.pattern, r.severity)
        for c in (contracts or RETAIL).values()
        for r in c.all_rules()
    ]
    schema = "table_name string, rule string, kind string, columns array<string>, check string, severity string"
    return spark.createDataFrame(rows, schema)


def contract_chunks(spark: SparkSession, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """One retrieval chunk per contract."""
    rows = []
    for c in (contracts or RETAIL).values():
        lines = [f"table {c.table} from {c.source_system} ({c.source_table}), owner {c.owner}"]
        lines += [f"column {f.name} {f.spark_type().simpleString()}{'' if f.nullable else ' required'}" for f in c.fields]
        lines += [f"rule {r.name} {r.kind} {r.expression or r.pattern}".rstrip() for r in c.rules]
        meta = {"table": c.table, "source_system": c.source_system, "owner": c.owner}
        rows.append(("\n".join(lines), f"contracts#{c.table}", "contract", meta))
    return spark.createDataFrame(rows, "content string, source string, chunk_type string, metadata map<string,string>")
