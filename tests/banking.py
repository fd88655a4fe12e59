"""Fifty rows of bank transactions: clean ones, repairable ones, and one row for each defect."""

from __future__ import annotations

import csv

BASE = {
    "transaction_id": "", "transaction_date": "2024-03-05", "transaction_time": "10:15:30", "transaction_type": "Purchase", "transaction_amount": "250.75", "currency": "EGP", "transaction_fee": "0.0", "balance_after_transaction": "9000.5",
    "transaction_status": "Completed", "channel": "POS", "card_type": "Visa Debit", "merchant_name": "Metro Market", "merchant_category": "Groceries", "channel_feature": "Assisted/Physical", "digital_feature_use": "Not Applicable",
    "login_success": "", "session_duration_seconds": "120", "attempt_count": "1", "failure_reason": "", "estimated_channel_cost_egp": "1.5", "digital_channel_flag": "0", "account_id": "", "account_type": "Savings", "account_open_date": "2020-05-01",
    "account_status": "Active", "interest_rate": "8.5", "customer_id": "", "customer_first_name": "Mona", "customer_last_name": "Sami", "gender": "Female", "date_of_birth": "1985-06-07", "marital_status": "Married", "email": "", "phone_number": "",
    "customer_city": "Giza", "customer_governorate": "Giza", "customer_segment": "Retail", "occupation": "Engineer", "annual_income": "150000", "credit_score": "700", "customer_since_date": "2018-02-03",
    "bank_id": "BNK01", "bank_name": "Banque Misr", "bank_type": "public", "branch_id": "BR001", "branch_name": "Main Branch", "branch_city": "Cairo", "branch_governorate": "Cairo", "branch_region": "Greater Cairo",
}
#: row -> (rule that must catch it, outcome, changes)
DEFECTS = {
    21: ("DQ-PRE-001", "repaired", {"transaction_type": "  Purchase  "}), 22: ("DQ-PRE-002", "repaired", {"failure_reason": "N/A"}), 23: ("SCH-customer_segment-allowed_values", "repaired", {"customer_segment": "RETAIL"}),
    24: ("SCH-transaction_date-type", "repaired", {"transaction_date": "05/03/2024"}), 25: ("SCH-transaction_time-type", "repaired", {"transaction_time": "07:19:20 PM"}), 26: ("SCH-annual_income-type", "repaired", {"annual_income": "150,000.50"}),
    27: ("SCH-bank_id-pattern", "repaired", {"bank_id": "BNK-01"}), 28: ("SCH-customer_last_name-pattern", "repaired", {"customer_last_name": "Sami3"}), 29: ("DQ-CUS-001", "repaired", {"phone_number": "+20 10 1234 5629"}),
    31: ("DQ-PRE-003", "removed", {}), 32: ("SCH-email-pattern", "flagged", {"email": "a@@b.com"}), 33: ("DQ-CUS-001", "flagged", {"phone_number": "abc#123"}), 34: ("DQ-VAL-001", "flagged", {"transaction_type": "Deposit", "transaction_fee": "15.00", "merchant_name": "", "merchant_category": ""}),
    35: ("DQ-CMP-005", "flagged", {"channel": "ATM", "transaction_type": "Withdrawal", "card_type": "", "merchant_name": "", "merchant_category": ""}), 36: ("DQ-TML-003", "flagged", {"customer_since_date": "2015-01-01", "date_of_birth": "2000-01-01", "account_open_date": "2016-01-01"}),
    39: ("DQ-REL-002", "flagged", {"gender": "Male"}), 40: ("SCH-customer_id-not_null", "quarantined", {"customer_id": ""}), 41: ("SCH-credit_score-range", "quarantined", {"credit_score": "0"}), 42: ("SCH-transaction_type-allowed_values", "quarantined", {"transaction_type": "Teleport"}),
    43: ("SCH-transaction_amount-type", "quarantined", {"transaction_amount": "abc"}), 44: ("SCH-transaction_date-range", "quarantined", {"transaction_date": "2099-01-01"}), 45: ("SCH-account_id-pattern", "quarantined", {"account_id": "XYZ"}),
    46: ("SCH-branch_id-reference", "quarantined", {"branch_id": "BR999"}), 47: ("DQ-TML-001", "quarantined", {"account_open_date": "2024-12-31", "transaction_date": "2024-03-05"}), 48: ("SCH-transaction_id-unique", "quarantined", {}), 49: ("SCH-transaction_id-unique", "quarantined", {"transaction_amount": "251.75"}),
    50: ("DQ-REV-001", "quarantined", {"occupation": " Engineer ", "transaction_time": "07:19:20 PM", "customer_segment": "RETAIL"}),
}


def rows() -> list[dict]:
    out = []
    for n in range(1, 51):
        person = 37 if n in (38, 39) else n
        row = BASE | {"transaction_id": f"TXN{n:010d}", "account_id": f"ACC{person:07d}", "customer_id": f"CUST{person:06d}", "email": f"mona{person}@mail.com", "phone_number": f"010123456{person:02d}"}
        row |= DEFECTS.get(n, ("", "", {}))[2]
        if n == 31:
            row = dict(out[-1])
        if n == 49:
            row = dict(out[-1]) | DEFECTS[49][2]
        out.append(row)
    return out


def write(folder) -> str:
    """The file and its lookup files; returns the file's path."""
    (folder / "config/reference").mkdir(parents=True)
    (folder / "config/reference/banks.csv").write_text("bank_id,bank_name,bank_type\nBNK01,Banque Misr,public\n")
    (folder / "config/reference/branches.csv").write_text("branch_id,branch_name\nBR001,Main Branch\n")
    path = folder / "transactions.csv"
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.DictWriter(f, BASE)
        out.writeheader()
        out.writerows(rows())
    return str(path)
