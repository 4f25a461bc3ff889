"""How each class of personal data is replaced."""

from __future__ import annotations

# Numbers 0 to 255.
QUAD = "([0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Class, generator, its settings, consistent (same input, same
# output), unique (different inputs, different outputs). Classes not listed
# have no generator. IP_ADDRESS makes dotted quads. A text of a pattern is one
# that the pattern matches as a whole.
GENERATORS = (
    ("ACCOUNT_NAME", "string", {"low": 10, "high": 20}, False, False),
    ("ACCOUNT_NUMBER", "number", {"low": 1000, "high": 1000000}, True, True),
    ("ADDRESS", "string", {"low": 20, "high": 25}, False, False),
    ("AFFILIATE_NAME", "string", {"low": 10, "high": 20}, True, True),
    ("AGE", "number", {"low": 18, "high": 99}, False, False),
    ("BANK_ACCOUNT", "number", {"low": 10000000, "high": 99999999}, True, True),
    ("BUSINESS_NAME", "string", {"low": 10, "high": 20}, True, False),
    ("CARDHOLDER_NAME", "string", {"low": 10, "high": 20}, True, False),
    ("CREDIT_CARD", "credit_card", {"prefix_length": 0}, True, True),
    ("DEBIT_CARD", "credit_card", {"prefix_length": 4}, False, False),
    ("DRIVER_LICENSE", "pattern", {"pattern": r"\b[A-Z]{1,2}\d{1,6}[A-Z]?\b"}, True, False),
    ("EMAIL", "pattern", {"pattern": r"[a-z0-9\.]{6,20}@[a-z\.]{4,10}\.(com|net|org)"}, True, True),
    ("FIRST_NAME", "string", {"low": 5, "high": 15}, False, False),
    ("FULL_NAME", "string", {"low": 10, "high": 20}, True, False),
    ("GENDER", "choice", {"items": ["Male", "Female"]}, False, False),
    ("IP_ADDRESS", "pattern", {"pattern": QUAD + r"(\." + QUAD + "){3}"}, True, True),
    ("LANGUAGE", "choice", {"items": ["English", "French", "Spanish", "Portuguese"]}, False, False),
    ("LAST_NAME", "string", {"low": 10, "high": 20}, False, False),
    ("MAC_ADDRESS", "pattern", {"pattern": r"^([0-9A-F]{2}[:-]){5}([0-9A-F]{2})$"}, True, True),
    ("MIDDLE_NAME", "string", {"low": 10, "high": 20}, False, False),
    ("NAME", "string", {"low": 10, "high": 20}, False, False),
    ("POSTAL_CODE", "pattern", {"pattern": r"^\d{5}(-\d{4})?$"}, False, False),
    (
        "RACE_ETHNICITY",
        "choice",
        {"items": ["White", "Black", "African American", "American Indian", "Alaska Native", "Asian", "Hawaiian"]},
        False,
        False,
    ),
    (
        "RELIGION",
        "choice",
        {
            "items": [
                "Christian", "Catholic", "Jehovah's Witness", "Jewish", "Muslim",
                "Buddhist", "Hindu", "Atheist", "Agnostic",
            ]
        },
        False,
        False,
    ),
    ("SOCIAL_SECURITY_NUMBER", "ssn", {"delimiter": "-"}, True, True),
    ("STATE", "pattern", {"pattern": r"[A-Z]{2}"}, False, False),
    ("TELEPHONE_NUMBER", "pattern", {"pattern": r"\+1 \([2-9][0-9]{2}\)-[2-9][0-9]{2}-[0-9]{4}"}, False, False),
    ("USERNAME", "string", {"low": 6, "high": 12}, False, False),
)

BY_CLASS = {row[0]: row[1:] for row in GENERATORS}
