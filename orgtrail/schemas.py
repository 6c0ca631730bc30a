"""Schemas of the registry tables."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

TEXT, DATE, DOUBLE, INT = StringType(), DateType(), DoubleType(), IntegerType()


def _struct(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


ADDRESS = _struct(
    street=TEXT, number=TEXT, box=TEXT, zip_code=TEXT, city=TEXT, province=TEXT, country_code=TEXT
)
ADDRESS_HIST = _struct(start_date=DATE, end_date=DATE, address_nl=ADDRESS, address_fr=ADDRESS)
ACTIVITY = _struct(
    classification=TEXT, type_label=TEXT, code=TEXT, description_nl=TEXT, description_fr=TEXT
)
MANDATE = _struct(
    pid=TEXT, category=TEXT, role=TEXT, function=TEXT, start_date=DATE, end_date=DATE
)
PARTICIPATION = _struct(related_vat=TEXT, interests_type=TEXT, percentage=DOUBLE, source=TEXT)
ACCOUNT_SUMMARY = _struct(
    period_end_date=DATE,
    profit_loss=_struct(
        turnover=DOUBLE, ebitda=DOUBLE, operating_profit=DOUBLE, profit_after_tax=DOUBLE
    ),
    balance_sheet=_struct(equity=DOUBLE, land_buildings=DOUBLE),
    employees=INT,
    schema_type=TEXT,
    currency=TEXT,
    financial_health=DOUBLE,
)
# The other shape of yearly accounts: profit and turnover in the balance sheet, health in an analysis.
AMOUNT = _struct(current=DOUBLE, previous=DOUBLE)
ACCOUNT_SUMMARY_BY_SHEET = _struct(
    period_end_date=DATE,
    balance_sheet=_struct(
        gain_loss_period=AMOUNT, turnover=AMOUNT, equity=AMOUNT, land_buildings=AMOUNT
    ),
    financial_analysis=_struct(ebitda=DOUBLE, financial_health_indicator=DOUBLE),
    employees=INT,
    schema_type=TEXT,
    currency=TEXT,
)

ORGANISATIONS = _struct(
    vat=TEXT,
    name_nl=TEXT,
    name_fr=TEXT,
    name=TEXT,
    juridical_form=TEXT,
    juridical_situation=TEXT,
    founding_date=DATE,
    employee_count=INT,
    financial_health=DOUBLE,
    address_nl=ADDRESS,
    address_fr=ADDRESS,
    address_hists=ArrayType(ADDRESS_HIST),
    activities=ArrayType(ACTIVITY),
    person_mandates=ArrayType(MANDATE),
    participation_hists=ArrayType(PARTICIPATION),
)
PERSONS = _struct(
    pid=TEXT,
    first_name=TEXT,
    last_name=TEXT,
    name=TEXT,
    is_moral=BooleanType(),
    address_hists=ArrayType(ADDRESS_HIST),
)
# Mandates as a table of their own, beside or instead of the array in a company.
MANDATES = StructType(_struct(vat=TEXT).fields + MANDATE.fields)
ANNUAL_ACCOUNTS = _struct(vat=TEXT, summaries=ArrayType(ACCOUNT_SUMMARY))
ANNUAL_ACCOUNTS_BY_SHEET = _struct(vat=TEXT, summaries=ArrayType(ACCOUNT_SUMMARY_BY_SHEET))
ESTABLISHMENTS = _struct(
    vat=TEXT,
    est_id=LongType(),
    name_nl=TEXT,
    name_fr=TEXT,
    start_date=DATE,
    end_date=DATE,
    address_nl=ADDRESS,
    address_fr=ADDRESS,
    telephone=TEXT,
    email=TEXT,
    website=TEXT,
    activities=ArrayType(TEXT),
)
PUBLICATIONS = _struct(
    publication_number=TEXT,
    publication_date=DATE,
    pdf_link=TEXT,
    language=TEXT,
    subjects=ArrayType(TEXT),
    source=TEXT,
    organizations=ArrayType(_struct(vat=TEXT)),
)
VAT_LIST = _struct(vat=TEXT)

REGISTRY = {
    "organisations": ORGANISATIONS,
    "persons": PERSONS,
    "annual_accounts": ANNUAL_ACCOUNTS,
    "establishments": ESTABLISHMENTS,
    "publications": PUBLICATIONS,
}

# Tables that come in several shapes, the usual one first.
SHAPES = {"annual_accounts": (ANNUAL_ACCOUNTS, ANNUAL_ACCOUNTS_BY_SHEET)}
