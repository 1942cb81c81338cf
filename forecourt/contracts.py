"""Declared schemas, keys, domains and thresholds of the eight source datasets.

Every list the rest of the library needs (primary keys, foreign keys, allowed
values, critical columns, ...) is derived from the ``Field`` declarations below,
so there is one place to read or to change a rule.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

TEXT = T.StringType()
DATE = T.DateType()
INSTANT = T.TimestampNTZType()
MONEY = T.DecimalType(14, 2)
SMALL = T.ShortType()
WHOLE = T.IntegerType()
FLAG = T.BooleanType()


@dataclass(frozen=True)
class Field:
    """One source column: type plus the rules that profiling and cleaning apply."""

    name: str
    type: T.DataType = TEXT
    identifier: bool = False
    critical: bool = False
    nonnegative: bool = False
    domain: tuple[str, ...] | None = None
    references: tuple[str, str] | None = None


@dataclass(frozen=True)
class Dataset:
    name: str
    key: str
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def knows(self, name: str) -> bool:
        return name in self.columns

    def where(self, test) -> list[Field]:
        return [f for f in self.fields if test(f)]

    @property
    def dates(self) -> list[Field]:
        return self.where(lambda f: f.type in (DATE, INSTANT))

    @property
    def numbers(self) -> list[Field]:
        return self.where(lambda f: f.type in (MONEY, SMALL, WHOLE))

    @property
    def flags(self) -> list[Field]:
        return self.where(lambda f: f.type == FLAG)

    @property
    def critical(self) -> list[str]:
        return [f.name for f in self.fields if f.critical]

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, TEXT) for c in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    def with_domains(self, **domains: tuple[str, ...]) -> Dataset:
        """Copy of the dataset with some value domains replaced."""
        fields = tuple(replace(f, domain=domains.get(f.name, f.domain)) for f in self.fields)
        return replace(self, fields=fields)


def _ident(name, references=None, critical=True):
    return Field(name, identifier=True, critical=critical, references=references)


def _amount(name, critical=True):
    return Field(name, MONEY, critical=critical, nonnegative=True)


# Dataset names, column order, types, keys, domains of the source contract.
ROLES = ("Sales Consultant", "Service Advisor", "Service Technician", "Inventory Specialist", "Manager")
SALES_ROLE, ADVISOR_ROLE, TECHNICIAN_ROLE = ROLES[:3]

CUSTOMERS = Dataset("customers", "customer_id", (
    _ident("customer_id"),
    Field("first_name"),
    Field("last_name"),
    Field("email"),
    Field("phone"),
    Field("city"),
    Field("state"),
    Field("postal_code"),
    Field("customer_since_date", DATE, critical=True),
    Field("customer_type", domain=("Individual", "Business", "Fleet")),
))

VEHICLES = Dataset("vehicles", "vehicle_id", (
    _ident("vehicle_id"),
    _ident("vin"),
    Field("make"),
    Field("model"),
    Field("model_year", SMALL, critical=True),
    Field("body_type"),
    Field("fuel_type"),
    Field("color"),
    Field("vehicle_condition", domain=("New", "Used")),
    Field("mileage_at_acquisition", WHOLE, nonnegative=True),
    _amount("manufacturer_msrp"),
))

DEALERSHIPS = Dataset("dealerships", "dealership_id", (
    _ident("dealership_id"),
    Field("dealership_name"),
    Field("city"),
    Field("state"),
    Field("postal_code"),
    Field("region"),
    Field("opened_date", DATE, critical=True),
))

EMPLOYEES = Dataset("employees", "employee_id", (
    _ident("employee_id"),
    _ident("dealership_id", ("dealerships", "dealership_id")),
    Field("first_name"),
    Field("last_name"),
    Field("role", critical=True, domain=ROLES),
    Field("hire_date", DATE, critical=True),
    Field("employment_status", domain=("Active", "Inactive")),
))

SALES = Dataset("sales", "sale_id", (
    _ident("sale_id"),
    Field("sale_date", DATE, critical=True),
    _ident("customer_id", ("customers", "customer_id")),
    _ident("vehicle_id", ("vehicles", "vehicle_id")),
    _ident("dealership_id", ("dealerships", "dealership_id")),
    _ident("salesperson_id", ("employees", "employee_id")),
    Field("sales_channel", domain=("Showroom", "Online", "Fleet", "Partner")),
    _amount("list_price"),
    _amount("discount_amount"),
    _amount("sale_price"),
    _amount("vehicle_cost"),
    _amount("gross_profit"),
    Field("payment_type", domain=("Finance", "Cash", "Lease")),
    Field("sale_status", domain=("Completed",)),
))

INVENTORY = Dataset("inventory", "inventory_id", (
    _ident("inventory_id"),
    Field("snapshot_date", DATE, critical=True),
    _ident("vehicle_id", ("vehicles", "vehicle_id")),
    _ident("dealership_id", ("dealerships", "dealership_id")),
    Field("acquired_date", DATE, critical=True),
    Field("inventory_status", domain=("Available", "Reserved", "In Transit", "Demonstrator")),
    _amount("carrying_cost"),
    Field("days_in_inventory", WHOLE, critical=True, nonnegative=True),
    Field("slow_moving_flag", FLAG, critical=True),
))

APPOINTMENTS = Dataset("service_appointments", "appointment_id", (
    _ident("appointment_id"),
    _ident("customer_id", ("customers", "customer_id")),
    _ident("vehicle_id", ("vehicles", "vehicle_id")),
    _ident("dealership_id", ("dealerships", "dealership_id")),
    _ident("service_advisor_id", ("employees", "employee_id")),
    Field("appointment_date", DATE, critical=True),
    Field("appointment_time"),
    Field("service_type"),
    Field("appointment_status", critical=True, domain=("Completed", "Scheduled", "Cancelled", "No Show")),
))

ORDERS = Dataset("service_orders", "service_order_id", (
    _ident("service_order_id"),
    _ident("appointment_id", ("service_appointments", "appointment_id")),
    _ident("customer_id", ("customers", "customer_id")),
    _ident("vehicle_id", ("vehicles", "vehicle_id")),
    _ident("dealership_id", ("dealerships", "dealership_id")),
    _ident("service_advisor_id", ("employees", "employee_id")),
    _ident("technician_id", ("employees", "employee_id")),
    Field("opened_at", INSTANT, critical=True),
    Field("promised_at", INSTANT, critical=True),
    Field("completed_at", INSTANT, critical=True),
    Field("order_status", domain=("Completed",)),
    Field("payer_type", domain=("Customer Pay", "Warranty", "Internal")),
    _amount("labor_revenue"),
    _amount("parts_revenue"),
    _amount("discount_amount"),
    _amount("service_revenue"),
))

DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (CUSTOMERS, VEHICLES, DEALERSHIPS, EMPLOYEES, SALES, INVENTORY, APPOINTMENTS, ORDERS)
}

# Columns an order shares with its appointment; the appointment is authoritative.
SHARED_ORDER_COLUMNS = ("customer_id", "vehicle_id", "dealership_id", "service_advisor_id")

# (dataset, employee column, role) links that an ordinary foreign key cannot express.
ROLE_LINKS = (
    ("sales", "salesperson_id", SALES_ROLE),
    ("service_appointments", "service_advisor_id", ADVISOR_ROLE),
    ("service_orders", "service_advisor_id", ADVISOR_ROLE),
    ("service_orders", "technician_id", TECHNICIAN_ROLE),
)

# Fixed values of the warehouse and analytics rules.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
MONEY_TOLERANCE = "0.02"
SLOW_DAYS = 90
INACTIVE_DAYS = 365
RECOGNISED_SALES = ("Completed", "Returned")
AGING_BUCKETS = (("0-30", 0, 30), ("31-60", 31, 60), ("61-90", 61, 90), ("91-120", 91, 120))
OPEN_BUCKET = "120+"
SERVICE_CATEGORIES = {
    "Preventive": ("Maintenance", "Inspection"),
    "Corrective": ("Repair", "Recall"),
    "Tire Services": ("Tires",),
}
OTHER_SERVICES = "Other"
WAREHOUSE_DOMAINS = {
    "customer_type": ("Individual", "Business", "Fleet"),
    "vehicle_condition": ("New", "Used"),
    "role": ROLES,
    "employment_status": ("Active", "Inactive"),
    "sales_channel": ("Showroom", "Online", "Fleet", "Partner"),
    "payment_type": ("Finance", "Cash", "Lease"),
    "sale_status": ("Completed", "Returned", "Cancelled"),
    "inventory_status": (
        "Available", "Reserved", "In Transit", "Demonstrator", "Sold Not Delivered", "Unavailable",
    ),
    "order_status": ("Completed", "Cancelled", "Reopened"),
    "payer_type": ("Customer Pay", "Warranty", "Internal"),
}
EFFECTIVE_FROM, EFFECTIVE_TO = "1900-01-01", "9999-12-31"
CLV_METHOD = "Revenue-based interim CLV"


def foreign_keys() -> list[tuple[str, str, str, str]]:
    """(child, child column, parent, parent column) in declaration order."""
    return [
        (d.name, f.name, *f.references)
        for d in DATASETS.values()
        for f in d.fields
        if f.references
    ]
