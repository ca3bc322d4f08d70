"""Record rules for the domains the library is tested on."""

from __future__ import annotations

from limpid.operators.records import RecordRules

# Accepted spellings (trimmed, lower case) and their canonical labels.
DEPARTMENTS = {
    "hr": "HR",
    "human resources": "HR",
    "it": "IT",
    "information technology": "IT",
    "sales": "Sales",
    "finance": "Finance",
    "marketing": "Marketing",
}
GENDERS = {"m": "Male", "male": "Male", "f": "Female", "female": "Female"}
BLOOD_GROUPS = {
    spelling: group + sign
    for group in ("A", "B", "AB", "O")
    for sign, word in (("+", "positive"), ("-", "negative"))
    for spelling in (f"{group.lower()}{sign}", f"{group.lower()} {sign}", f"{group.lower()} {word}")
}
DIAGNOSES = {
    "diabetes": "Diabetes",
    "type 2 diabetes": "Diabetes",
    "hypertension": "Hypertension",
    "asthma": "Asthma",
    "migraine": "Migraine",
}
PRODUCT_CATEGORIES = {
    "electronics": "Electronics",
    "elec.": "Electronics",
    "fashion": "Fashion",
    "apparel": "Fashion",
    "home & kitchen": "Home & Kitchen",
    "home and kitchen": "Home & Kitchen",
}
SELLERS = {"sellera": "SellerA", "bestdeals": "BestDeals", "quickkart": "QuickKart"}
DEGREES = {
    "b.tech": "B.Tech",
    "btech": "B.Tech",
    "bachelor of technology": "B.Tech",
    "m.tech": "M.Tech",
    "mtech": "M.Tech",
    "mba": "MBA",
    "bca": "BCA",
}
UNIVERSITIES = {
    "iit delhi": "IIT Delhi",
    "mumbai university": "Mumbai University",
    "anna university": "Anna University",
    "delhi university": "Delhi University",
}
STATUSES = {"selected": "Selected", "rejected": "Rejected", "on hold": "On Hold", "on_hold": "On Hold"}

EMPLOYEES = RecordRules(
    names=("Name",), required=("Name",), categories={"Department": DEPARTMENTS}, emails=("Email",),
    phones=("Phone",), dates=("Date_of_Joining",), amounts=("Salary",), scores={"Rating": (1, 5)})

PATIENTS = RecordRules(
    names=("Name",), required=("Name",),
    categories={"Gender": GENDERS, "Blood_Group": BLOOD_GROUPS, "Diagnosis": DIAGNOSES},
    phones=("Phone",), dates=("Admission_Date",), amounts=("Bill_Amount",), ranges={"Age": (0, 120)})

PRODUCTS = RecordRules(
    names=("Product_Name",), required=("Product_Name",),
    categories={"Category": PRODUCT_CATEGORIES, "Seller": SELLERS}, dates=("Listed_Date",),
    amounts=("Price",), plain_amounts=("Reviews_Count",), scores={"Rating": (1, 5)})

APPLICANTS = RecordRules(
    names=("Name",), required=("Name",),
    categories={"Degree": DEGREES, "University": UNIVERSITIES, "Status": STATUSES},
    emails=("Email",), phones=("Phone",), dates=("Applied_Date",), counts={"Experience_Years": {"fresher": 0}})
