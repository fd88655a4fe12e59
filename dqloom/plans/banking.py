"""The rule set for a denormalised table of bank transactions: 52 columns, 152 rules. Lookup files of banks and branches are the user's."""

from __future__ import annotations

# The domains of this dataset.
DIGITAL = ["InstaPay", "Internet Banking", "Mobile App"]
ASSISTED = ["ATM", "Branch", "Call Center", "POS", "System"]
GOVERNORATES = [
    "Alexandria", "Assiut", "Aswan", "Beheira", "Beni Suef", "Cairo", "Dakahlia", "Damietta", "Fayoum", "Gharbia", "Giza", "Ismailia", "Kafr El Sheikh", "Luxor", "Matrouh", "Minya",
    "Monufia", "New Valley", "North Sinai", "Port Said", "Qalyubia", "Qena", "Red Sea", "Sharqia", "Sohag", "South Sinai", "Suez",
]
CITIES = [
    "6th of October City", "Alexandria", "Assiut", "Aswan", "Banha", "Beni Suef", "Cairo", "Damanhur", "Damietta", "El Mahalla El Kubra", "Fayoum", "Giza", "Hurghada", "Ismailia",
    "Kafr El Sheikh", "Luxor", "Mansoura", "Marsa Matruh", "Minya", "New Cairo", "Port Said", "Qena", "Sharm El Sheikh", "Shibin El Kom", "Shubra El Kheima", "Sohag", "Suez", "Tanta", "Zagazig",
]
MERCHANTS = [
    "2B Egypt", "Abou El Sid", "Al Borg Laboratories", "Amazon.eg", "B.TECH", "BIM Egypt", "Bazooka", "Cairo Water Company", "Carrefour Egypt", "Cleopatra Hospitals", "Co-op Petroleum", "Concrete",
    "Cook Door", "Dalydress", "e& Egypt", "Egypt Gas", "EgyptAir", "Egyptian Electricity Holding Co.", "Egyptian National Railways", "El Ezaby Pharmacy", "Gad", "Go Bus", "Jumia Egypt", "Kazyon",
    "Koshary El Tahrir", "Metro Market", "Misr Petroleum", "Noon Egypt", "Orange Egypt", "Other", "Raya Shop", "Seif Pharmacies", "Seoudi Market", "Shahid", "Spinneys Egypt", "Talabat",
    "TotalEnergies Egypt", "Town Team", "Tradeline", "Travco", "VOX Cinemas", "Vodafone Egypt", "WE Telecom Egypt", "Wataniya Petroleum", "Watch It", "Zooba",
]
MERCHANT_CATEGORIES = ["Electronics", "Entertainment", "Fashion", "Fuel", "Groceries", "Healthcare", "Online Shopping", "Other", "Restaurants", "Travel", "Utilities & Telecom"]
TRANSACTION_TYPES = ["Bill Payment", "Deposit", "Fee", "Interest Credit", "Loan Repayment", "Purchase", "Transfer", "Withdrawal"]
OCCUPATIONS = [
    "Accountant", "Business Owner", "Doctor", "Driver", "Engineer", "Farmer", "Government Employee", "Housewife", "IT Specialist", "Lawyer", "Merchant", "Pharmacist", "Retired",
    "Sales Representative", "Student", "Teacher", "Unemployed",
]
BANKS = [
    "Abu Dhabi Islamic Bank Egypt", "Alex Bank", "Arab African International Bank", "Banque du Caire", "Banque Misr", "Commercial International Bank", "Credit Agricole Egypt",
    "Faisal Islamic Bank of Egypt", "Housing and Development Bank", "HSBC Egypt", "National Bank of Egypt", "QNB Egypt",
]
REGIONS = ["Alexandria & North Coast", "Canal", "Delta", "Greater Cairo", "Red Sea & Sinai", "Upper Egypt"]
RATES = {"EGP": 1, "USD": 52.40, "EUR": 56.59, "SAR": 13.97, "AED": 14.27}
NULL_TOKENS = ["", "null", "none", "nan", "n/a", "na", "#n/a", "nil", "-", "--", "?"]
DATE_FORMATS = ["%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%d %b %Y", "%d-%b-%Y", "%d-%b-%y", "%Y%m%d", "%Y-%m-%d"]
CURRENCY_SPELLINGS = {"LE": "EGP", "L.E.": "EGP", "E£": "EGP", "EG": "EGP", "جنيه": "EGP", "ج.م": "EGP"}
NAME_PATTERN = "^[A-Za-z]+(?:[ '-][A-Za-z]+)*$"
PHONE_PATTERN = r"^01[0125]\d{8}$"
EMAIL_PATTERN = r"^[A-Za-z][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.com$"


def _one_of(values: list[str], nullable: object = False) -> dict:
    return {"type": "string", "nullable": nullable, "allowed_values": values}


def _number(kind: str = "decimal", nullable: object = False, **limits: object) -> dict:
    return {"type": kind, "nullable": nullable, **limits}


def _date(low: str, high: str = "today") -> dict:
    return {"type": "date", "nullable": False, "source_format": "%Y-%m-%d", "min": low, "max": high}


def _flag(nullable: object = False, **more: object) -> dict:
    return {"type": "boolean", "nullable": nullable, "true_values": ["1"], "false_values": ["0"], **more}


def _text(pattern: str | None = None, **more: object) -> dict:
    return {"type": "string", "nullable": False, **({"pattern": pattern} if pattern else {}), **more}


def schema(banks: str = "config/reference/banks.csv", branches: str = "config/reference/branches.csv") -> dict:
    columns = {
        "transaction_id": _text(r"^TXN\d{10}$", unique=True), "transaction_date": _date("2022-01-01"), "transaction_time": {"type": "time", "nullable": False, "source_format": "%H:%M:%S"},
        "transaction_type": _one_of(TRANSACTION_TYPES), "transaction_amount": _number(min=0, exclusive_min=True, max=10000000),
        "currency": {**_one_of(["AED", "EGP", "EUR", "SAR", "USD"]), "pattern": "^[A-Z]{3}$"}, "amount_egp": _number(nullable="conditional", generated=True),
        "transaction_fee": _number(min=0), "balance_after_transaction": _number(min=0), "transaction_status": _one_of(["Completed", "Failed", "Pending", "Reversed"]),
        "channel": _one_of(["ATM", "Branch", "Call Center", "InstaPay", "Internet Banking", "Mobile App", "Other", "POS", "System"]),
        "card_type": _one_of(["Mastercard Credit", "Mastercard Debit", "Meeza", "Visa Credit", "Visa Debit"], "conditional"),
        "merchant_name": _one_of(MERCHANTS, "conditional"), "merchant_category": _one_of(MERCHANT_CATEGORIES, "conditional"),
        "channel_feature": _one_of(["Assisted/Physical", "Digital/Self-Service"]), "digital_feature_use": _one_of(["Funds Transfer", "Not Applicable"]), "login_success": _flag("conditional"),
        "session_duration_seconds": _number(min=0, exclusive_min=True, max=1800), "attempt_count": _number("integer", min=1, max=4),
        "failure_reason": _one_of(["Authentication Failed", "Insufficient Funds", "Network Timeout", "Other"], "conditional"), "estimated_channel_cost_egp": _number(min=0), "digital_channel_flag": _flag(),
        "digital_migration_opportunity": _flag("conditional", generated=True),
        "account_id": _text(r"^ACC\d{7}$"), "account_type": _one_of(["Certificate of Deposit", "Credit Card", "Current", "Loan", "Savings"]), "account_open_date": _date("1990-01-01"),
        "account_status": _one_of(["Active", "Closed", "Dormant", "Frozen"]), "interest_rate": _number(min=0, max=100),
        "customer_id": _text(r"^CUST\d{6}$"), "customer_first_name": _text(NAME_PATTERN, pii=True), "customer_last_name": _text(NAME_PATTERN, pii=True), "gender": _one_of(["Female", "Male"]),
        "date_of_birth": _date("1900-01-01", "today-18y") | {"pii": True}, "marital_status": _one_of(["Divorced", "Married", "Single", "Widowed"]), "email": _text(EMAIL_PATTERN, pii=True),
        "country_code": _one_of(["EG"], "conditional") | {"generated": True}, "phone_number": _text(PHONE_PATTERN, pii=True), "customer_city": _one_of(CITIES), "customer_governorate": _one_of(GOVERNORATES),
        "customer_segment": _one_of(["Corporate", "Premium", "Private Banking", "Retail", "SME"]), "occupation": _one_of(OCCUPATIONS), "annual_income": _number(min=0, exclusive_min=True) | {"pii": True},
        "credit_score": _number("integer", min=300, max=850), "customer_since_date": _date("1990-01-01"),
        "bank_id": _text(r"^BNK\d{2}$", reference={"path": banks, "column": "bank_id"}), "bank_name": _one_of(BANKS), "bank_type": _one_of(["private", "public"]),
        "branch_id": _text(r"^BR\d{3}$", reference={"path": branches, "column": "branch_id"}), "branch_name": _text(reference={"path": branches, "column": "branch_name"}),
        "branch_city": _one_of(CITIES), "branch_governorate": _one_of(GOVERNORATES), "branch_region": _one_of(REGIONS),
    }
    customer = ["customer_first_name", "customer_last_name", "gender", "date_of_birth", "marital_status", "email", "country_code", "phone_number", "customer_city", "customer_governorate", "customer_segment", "occupation", "annual_income", "credit_score", "customer_since_date"]
    return {
        "dataset": {"name": "banking_transactions", "source": {"delimiter": ",", "encoding": "utf-8-sig"}, "primary_key": ["transaction_id"], "null_tokens": NULL_TOKENS, "canonical_formats": {"date": "%Y-%m-%d", "time": "%H:%M:%S", "year_month": "%Y-%m"}},
        "entities": {
            "transaction": {"key": "transaction_id", "references": {"account": "account_id", "branch": "branch_id"}},
            "account": {"key": "account_id", "attributes": ["account_type", "account_open_date", "account_status", "interest_rate"], "references": {"customer": "customer_id"}},
            "customer": {"key": "customer_id", "attributes": customer},
            "bank": {"key": "bank_id", "attributes": ["bank_name", "bank_type"]},
            "branch": {"key": "branch_id", "attributes": ["branch_name", "branch_city", "branch_governorate", "branch_region"], "references": {"bank": "bank_id"}},
        },
        "dependencies": {
            "merchant": {"determinant": "merchant_name", "dependents": ["merchant_category"]},
            "customer_location": {"determinant": "customer_city", "dependents": ["customer_governorate"]},
            "branch_location": {"determinant": "branch_city", "dependents": ["branch_governorate", "branch_region"]},
        },
        "columns": columns,
    }


def _within(column: str, values: list[str]) -> dict:
    return {"column": column, "in": values}


def _is(column: str, value: str) -> dict:
    return {"column": column, "equals": value}


def _ids(pattern: str | list[str], template: str) -> dict:
    return {"pattern": {"remediation": {"action": "reformat_id", "patterns": [pattern] if isinstance(pattern, str) else pattern, "template": template}}}


def rules() -> dict:
    number = {"type": {"remediation": {"action": "parse_number"}}}
    date = {"type": {"remediation": {"action": "parse_date", "formats": DATE_FORMATS}}}
    timely = {**date, "range": {"dimension": "timeliness"}}
    name = {"pattern": {"remediation": {"action": "replace", "substitutions": [
        {"pattern": "^(?:[A-Z]+_)+(?=[A-Z][a-z])", "replace": ""}, {"pattern": r"(?<=[A-Za-z])\?(?=[A-Za-z])", "replace": "'"}, {"pattern": "[^A-Za-z' -]", "replace": ""}, {"pattern": r"\s+", "replace": " "},
    ]}}}
    columns = {
        "transaction_id": _ids(r"^TXN[\s_-]?(\d{10})$", "TXN{0}"), "account_id": _ids([r"^(\d{1,7})$", r"^ACC[\s_-]?(\d{1,7})$"], "ACC{0:0>7}"), "customer_id": _ids(r"^(?:CUST|C)[\s_-]?(\d{6})$", "CUST{0}"),
        "bank_id": _ids(r"^BNK[\s_-]?(\d{1,2})$", "BNK{0:0>2}"), "branch_id": _ids(r"^BR[\s_-]?(\d{1,3})$", "BR{0:0>3}"),
        "transaction_date": timely, "account_open_date": timely, "customer_since_date": timely, "date_of_birth": date, "transaction_time": {"type": {"remediation": {"action": "parse_time"}}},
        "currency": {"pattern": {"enabled": False}, "allowed_values": {"remediation": {"action": "canonicalize", "map": CURRENCY_SPELLINGS}}},
        **{c: number for c in ("transaction_amount", "transaction_fee", "balance_after_transaction", "estimated_channel_cost_egp", "interest_rate", "annual_income", "credit_score")},
        "login_success": {"type": {"severity": "warning"}}, "session_duration_seconds": {"type": {"severity": "warning", **number["type"]}, "range": {"severity": "warning"}},
        "attempt_count": {"type": {"severity": "warning", **number["type"]}, "range": {"severity": "warning"}}, "customer_first_name": name, "customer_last_name": name,
        "email": {"pattern": {"severity": "warning"}}, "phone_number": {"pattern": {"enabled": False}}, "customer_city": {"allowed_values": {"severity": "warning"}, "not_null": {"severity": "warning"}},
        "occupation": {"allowed_values": {"severity": "warning"}},
    }
    critical = {"severity": "critical"}
    repaired = {**critical, "remediation": {"action": "canonicalize"}}
    out: list[dict] = []

    def add(id_: str, kind: str, dimension: str, severity: str = "warning", **more: object) -> None:
        out.append({"id": id_, "type": kind, "dimension": dimension, "severity": severity, **more})

    add("DQ-GEN-001", "generate", "consistency", "critical", name="amount_egp is the amount in EGP", column="amount_egp", method="convert_currency", amount="transaction_amount", currency="currency", rates=RATES, decimals=2)
    add("DQ-BUS-001", "expression", "consistency", "critical", name="EGP amounts stay as they are", expression="abs(amount_egp - transaction_amount) <= 0.01", columns=["amount_egp", "transaction_amount"], when=_is("currency", "EGP"), message="amount_egp {value} differs from transaction_amount for an EGP transaction")
    add("DQ-BUS-002", "expression", "validity", name="The fee is not above the amount", expression="transaction_fee <= transaction_amount", columns=["transaction_fee", "transaction_amount"], message="transaction_fee {value} is larger than the transaction amount")
    add("DQ-GEN-002", "generate", "consistency", name="Assisted transactions that could be digital", column="digital_migration_opportunity", method="case", default="0", cases=[{"when": {"all": [_within("channel", ["ATM", "Branch", "Call Center"]), _within("transaction_type", ["Transfer", "Bill Payment", "Loan Repayment"])]}, "value": "1"}])
    add("DQ-GEN-003", "generate", "completeness", name="country_code from the governorate", column="country_code", method="case", cases=[{"when": _within("customer_governorate", GOVERNORATES), "value": "EG"}])
    add("DQ-CUS-001", "pattern", "validity", name="Phone numbers of the country", column="phone_number", pattern=PHONE_PATTERN, when=_is("country_code", "EG"), on_accept="set_null", remediation={"action": "replace", "substitutions": [{"pattern": r"[\s().-]", "replace": ""}, {"pattern": r"^(?:\+|00)20(?=1)", "replace": "0"}]})
    pairs = [("digital_channel_flag", "1", "0"), ("digital_feature_use", "Funds Transfer", "Not Applicable"), ("channel_feature", "Digital/Self-Service", "Assisted/Physical")]
    for i, (column, digital, assisted) in enumerate(pairs):
        for j, (channels, value) in enumerate(((DIGITAL, digital), (ASSISTED, assisted))):
            add(f"DQ-CON-{2 + 2 * i + j:03d}", "allowed_values", "consistency", name=f"{column} fits the channel", column=column, values=[value], when=_within("channel", channels))
    without = ["Deposit", "Fee", "Interest Credit", "Loan Repayment", "Transfer", "Withdrawal"]
    sold = _within("transaction_type", ["Purchase", "Bill Payment"])
    for no, kind, column, when in [
        (1, "not_null", "login_success", _is("digital_channel_flag", "1")), (2, "is_null", "login_success", _is("digital_channel_flag", "0")), (5, "not_null", "card_type", _is("channel", "ATM")),
        (6, "is_null", "card_type", _within("channel", ["Branch", "Call Center", "InstaPay", "System"])), (7, "not_null", "merchant_name", sold), (8, "is_null", "merchant_name", _within("transaction_type", without)),
        (9, "not_null", "merchant_category", sold), (10, "is_null", "merchant_category", _within("transaction_type", without)), (11, "not_null", "failure_reason", _is("transaction_status", "Failed")),
        (12, "is_null", "failure_reason", _within("transaction_status", ["Completed", "Pending", "Reversed"])),
    ]:
        more = {"remediation": {"action": "set_null"}} if kind == "is_null" else {}
        add(f"DQ-CMP-{no:03d}", kind, "consistency" if kind == "is_null" else "completeness", name=f"{column} where it applies", column=column, when=when, **more)
    free = ["Bill Payment", "Deposit", "Fee", "Interest Credit", "Loan Repayment", "Purchase"]
    limits = [("transaction_fee", 0, 0, _within("transaction_type", free)), ("interest_rate", 0.5, 0.5, _is("account_type", "Current")), ("interest_rate", 5, 15, _is("account_type", "Savings")), ("interest_rate", 15, 30, _within("account_type", ["Certificate of Deposit", "Loan"])), ("interest_rate", 30, 45, _is("account_type", "Credit Card"))]
    for i, (column, low, high, when) in enumerate(limits):
        add(f"DQ-VAL-{i + 1:03d}", "range", "validity", name=f"{column} for this kind", column=column, min=low, max=high, when=when)
    for i, (left, right, severity, offset) in enumerate([("transaction_date", "account_open_date", "critical", None), ("account_open_date", "customer_since_date", "warning", None), ("customer_since_date", "date_of_birth", "warning", {"years": 18})]):
        add(f"DQ-TML-{i + 1:03d}", "compare", "timeliness", severity, name=f"{left} after {right}", left=left, operator=">=", right=right, **({"offset": offset} if offset else {}))
    for i, (key, value) in enumerate([("entity", "account"), ("entity", "customer"), ("entity", "bank"), ("entity", "branch"), ("dependency", "merchant"), ("dependency", "customer_location"), ("dependency", "branch_location")]):
        add(f"DQ-REL-{i + 1:03d}", "functional_dependency", "integrity" if i < 4 else "consistency", name=f"One set of values for each {value}", **{key: value})
    add("DQ-REV-001", "auto_fix_review", "validity", "critical", name="Records with many automatic repairs", min_changes=3, ignore_actions=[])
    return {
        "preprocessing": [
            {"id": "DQ-PRE-001", "type": "trim_whitespace", "columns": "all", "dimension": "validity", "severity": "info", "remediation": {"action": "trim"}},
            {"id": "DQ-PRE-002", "type": "null_tokens", "columns": "all", "dimension": "completeness", "severity": "info", "remediation": {"action": "set_null"}},
            {"id": "DQ-PRE-003", "type": "duplicate_rows", "dimension": "uniqueness", "severity": "info", "remediation": {"action": "drop_duplicates"}},
        ],
        "schema_checks": {"on_accept": "set_null", "defaults": {"allowed_values": repaired, "reference": {**repaired, "dimension": "integrity"}, "not_null": {"dimension": "completeness"}, "unique": {"dimension": "uniqueness"}}, "columns": columns},
        "rules": out,
    }
