"""Classes of personal data and the patterns that point to them."""

from __future__ import annotations

# Class, pattern for whole values, score.
DATA_PATTERNS = (
    ("DATE_OF_BIRTH", r'\b\d{1,2}[\/-]\d{1,2}[\/-]\d{4}\b', 0.87),
    ("CREDIT_CARD", r'\b(?:\d[ -]*?){13,16}\b', 0.8),
    ("DRIVER_LICENSE", r'\b[A-Z]{1,2}\d{1,6}[A-Z]?\b', 0.9),
    ("STATE", r'\b[A-Z]{2}\b', 0.9),
    ("PASSPORT", r'\b[A-Z]{2}[0-9]{7}\b', 0.89),
    ("ZIP_CODE", r'\b\d{5}(?:-\d{4})?\b', 0.2),
    ("SOCIAL_SECURITY_NUMBER", r'(?!000|666)[0-8][0-9]{2}-?(?!00)[0-9]{2}-?(?!0000)[0-9]{4}', 0.8),
    ("GENDER", r'(?i)(MALE|FEMALE)', 1.0),
    ("RACE_ETHNICITY", r'(?i)(WHITE|BLACK|AFRICAN AMERICAN|AMERICAN INDIAN|ALASKA NATIVE|ASIAN|HAWAIIAN)', 1.0),
    ("RELIGION", r"(?i)(Christian|Catholic|Jehovah's Witness|Jewish|Muslim|Buddhist|Hindu|Atheist|Agnostic)", 1.0),
    ("EMAIL", r'^[\w\-\+]+(\.[\w]+)*@[\w-]+(\.[\w]+)*(\.[a-z]{2,})$', 1.0),
    ("TELEPHONE_NUMBER", r'^[+]?\d{0,3}[ ]?\d{10}|^[+]?\d{0,3}[ ]?(?:\d{3}-){2}\d{4}|^[+]?\d{0,3}[ ]?\(\d{3}\)[ ]?\d{3}-?\d{4}', 0.6),
    ("IP_ADDRESS", r'(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)$', 1.0),
    ("MAC_ADDRESS", r'^([0-9A-F]{2}[:-]){5}([0-9A-F]{2})$', 0.85),
)

# Class, pattern for a whole column name, score.
NAME_PATTERNS = (
    ("ACCOUNT_NAME", r'(?i)(.*ACCOUNT_NA.*|.*ACCT_NA.*|.*PAYPAL[_-]?ID.*)', 1.0),
    ("ACCOUNT_NUMBER", r'(?i).*ACCOUNT_NU.*|(?i).*ACCT_NU.*|(?i)ACCOUNT', 1.0),
    ("ADDRESS", r'(?i)ADDRESS.*|(?i)ADR[_0-1]|.*(?i)ADDR.*', 1.0),
    ("AFFILIATE_ID", r'(?i)AFF.*ID', 0.95),
    ("AFFILIATE_NAME", r'(?i)AFF.*NAME', 0.95),
    ("AGE", r'(?i)AGE|(?i).*[_]{1}AGE|(?i)AGE[_]{1}.*', 0.5),
    ("ALIEN_REGISTRATION_NUMBER", r'(?i).*ALIEN.*', 0.8),
    ("ALTERNATIVE_IDENTITY", r'(?i)ALT.*_ID_?', 0.9),
    ("AUDIO", r'(?i).*AUDIO.*', 1.0),
    ("AUTHENTICATION_CREDENTIALS", r'(?i).*AUTH.*|(?i).*CREDENTIAL.*', 0.6),
    ("BANK_ACCOUNT", r'(?i)(BANK|BK|BNK)_(ACCOUNT|ACCT|ACCNT)', 1.0),
    ("BUSINESS_NAME", r'(?i)ORGANIZATION|(?i)PARTY|(?i)CONTRACTOR|.*(?i)COMPANY.*|.*(?i)SUPPLIER.*', 0.8),
    ("CARDHOLDER_NAME", r'(?i).*CARD.*NAME.*', 0.6),
    ("CITY", r'(?i)CITY.*|(?i)TOWN.*', 1.0),
    ("COUNTRY", r'(?i)COUNTRY', 1.0),
    ("COUNTRY", r'(?i)CN', 0.3),
    ("COUNTY", r'(?i)COUNTY', 1.0),
    ("CREDIT_CARD", r'(?i)CREDIT_CARD.*|(?i)PAYMENT[METHOD]?|(?i)PAYMENT[_]METHOD|(?i)PYMT|(?i)PYMNT', 0.9),
    ("CREDIT_CARD", r'(?i)CC', 0.4),
    ("CREDIT_SCORE", r'(?i)CREDIT_?SCORE', 1.0),
    ("DATE_OF_BIRTH", r'(?i)DOB|(?i)B[_]?DATE|(?i)BIRTHD[ATE]?|(?i)BIRTHDAY', 0.9),
    ("DEBIT_CARD", r'(?i).*DEBIT_CARD.*', 1.0),
    ("DEPARTMENT", r'(?i)DEPARTMENT', 1.0),
    ("DEVICE_ID", r'(?i)(IMEI|imei|LCCID|lccid|IMSI|imsi)', 1.0),
    ("DRIVER_LICENSE", r'(?i).*DRIVER.*|(?i).*DR.*[_]?LIC.*', 1.0),
    ("EMAIL", r'(?i)E.?MAIL.*|(?i)ELECTRONIC_MAIL.*', 1.0),
    ("FEDERAL_ISSUED_IDENTIFIER", r'(?i).*FEDERAL.*|(?i).*GOVERNMENT.*', 0.4),
    ("FINGERPRINTS", r'(?i)FINGER.*', 1.0),
    ("FIRST_NAME", r'(?i)FIRST[_]?NAME|(?i)NAME[_]?FIRST', 1.0),
    ("FIRST_NAME", r'(?i)FIRST[_]?N|(?i)N[_]?FIRST|(?i)F[_]?NAME|(?i)NAME[_]?F|(?i)N[_]?F|(?i)F[_]?N', 0.8),
    ("FQDN", r'(?i)FQDN', 1.0),
    ("FULL_NAME", r'(?i)FULL_?NAME', 1.0),
    ("GENDER", r'(?i)GENDER', 1.0),
    ("HAND_GEOMETRY", r'(?i)HAND.*', 0.6),
    ("HOUSE", r'(?i)HOUSE_?N|(?i)STREET_?NUM', 1.0),
    ("IDENTITY", r'^(?i)ID(.*)?ESB|^(?i)ID(.*)?VAL', 0.85),
    ("IDENTITY", r'^(?i)IDENTITY$', 0.5),
    ("IP_ADDRESS", r'(?i)(?<![A-Z])IP[_]?ADDR.*', 1.0),
    ("IRIS_PATTERNS", r'(?i)IRIS.*', 0.6),
    ("KEY", r'(?i)KEY|.*(?i)TOKEN.*', 0.9),
    ("LANGUAGE", r'(?i).*LANG.*|(?i).*LANGUAGE.*', 1.0),
    ("LAST_NAME", r'(?i)LAST[_]?NAME|(?i)NAME[_]?LAST', 1.0),
    ("LAST_NAME", r'(?i)LAST[_]?N|(?i)N[_]?LAST|(?i)L[_]?NAME|(?i)NAME[_]?L|(?i)N[_]?L|(?i)L[_]?N|(?i)L.*NAME', 0.8),
    ("LATITUDE", r'(?i)LATITUDE|(?i)LAT|(?i)PHI', 0.9),
    ("LICENSE_KEY", r'(?i)PROD.*KEY|(?i)LICENSE', 0.95),
    ("LINE", r'(?i)LINE.*', 1.0),
    ("LONGITUDE", r'(?i)LONGITUDE|(?i)LONG|(?i)LAMBDA', 0.9),
    ("LOT", r'(?i)LOT_?N', 0.9),
    ("MAC_ADDRESS", r'(?i).*MAC[_]?ADDR.*', 1.0),
    ("MIDDLE_NAME", r'(?i)MIDDLE_NAME|(?i)NAME_MIDDLE', 1.0),
    ("MIDDLE_NAME", r'(?i)MIDDLE[_]?N|(?i)N[_]?MIDDLE|(?i)M[_]?NAME|(?i)NAME[_]?M|(?i)N[_]?M|(?i)M[_]?N|(?i)M.*NAME', 0.8),
    ("NAME", r'(?i)CUST.*PARTY|(?i)CUST.*NAME|(?i)TECH.*NAME|(?i)CONT.*NAME', 0.85),
    ("NAME", r'(?i).*_NAME_?.*', 0.8),
    ("NAME", r'(?i).*NAME.*', 0.75),
    ("NATIONAL_ID", r'(?i).*NATIONAL[_]?(ID|NUM.*)', 0.9),
    ("NOTES", r'.*((?<=^)|(?<=[_-]))(?i)NOTE[S]?((?=$)|(?=[_-](?!(?i)(ID|DATE)))).*', 0.9),
    ("OCCUPATION", r'(?i)OCCUPATION|(?i)JOB[_]?TITLE', 1.0),
    ("ORIGIN", r'(?i).*ORIGIN.*', 0.5),
    ("OWNER", r'(?i).*OWNER.*', 1.0),
    ("PASSPORT", r'(?i).*PASSPORT.*', 1.0),
    ("PASSWORD", r'(?i)PASSWORD|(?i)PASSWD|(?i)SECRET', 1.0),
    ("PAYMENT_CODE", r'(?i)CC[_]?CODE|(?i)CVV|(?i)CVC.*|(?i)CID|(?i)PAY.*[_]?CODE', 1.0),
    ("PHOTOGRAPHS", r'(?i)(.*PHOTO.*|.*PICTURE.*)', 1.0),
    ("PIN", r'(?i).*[_]?PIN[_]?[N]?.*', 1.0),
    ("POSTAL_CODE", r'(?i)ZIP.*|(?i).*[_]?POSTAL[_].*', 0.9),
    ("RACE_ETHNICITY", r'(?i).*RACE.*', 0.5),
    ("REGION_ID", r'(?i).*REGION[_]?(ID|NUM.*)|(?i)_REGION', 0.9),
    ("RELIGION", r'(?i)RELIGION.*', 0.9),
    ("RETINA_SCANNING", r'(?i).*RETINA.*', 1.0),
    ("RISK_SCORE", r'(?i)SCORE', 0.8),
    ("ROUTING_NUMBER", r'(?i)ROUTING[_]?NUM(BER)?|(?i)ROUTING[_]?NB', 0.9),
    ("SERIAL_NUMBER", r'(?i).*SERIAL[_]NUMBER.*', 1.0),
    ("SIGNATURES", r'(?i)SIGNATURE.*', 1.0),
    ("SIP_ADDRESS", r'(?i).*SIP[_]?ADDR.*', 1.0),
    ("SOCIAL_MEDIA", r'(?i).*SOCIAL.*', 0.8),
    ("SOCIAL_SECURITY_NUMBER", r'(?i)(SSN|SOCIAL[_ ]?SECURITY[_ ]?N.*)', 0.95),
    ("STATE_ID", r'(?i).*STATE[_]?(ID|NUM.*)', 0.8),
    ("STATE", r'(?i)STATE.*', 0.9),
    ("STATEMENT", r'(?i)(STATEMENT.*|INVOICE[_]?IMAGE)', 0.8),
    ("STREET", r'.*(?i)STREET.*', 1.0),
    ("TAX_ID", r'(?i).*TAX[_]?ID.*|(?i).*TAX[_]?N.*|(?i).*TAXPAYER[_]?ID.*|(?i).*TAXPAYER[_]?N.*', 1.0),
    ("TAX_ID", r'(?i).*TAX.?ID.*', 0.9),
    ("TELEPHONE_NUMBER", r'(?i)AFF.*NUM', 0.9),
    ("TELEPHONE_NUMBER", r'(?i)MSISDN|.*(?i)PHONE.*|(?i)PHONE[_]?NUM[BER]?|(?i)PHONE[_]?NB|(?i).*WIRELESS_N.*|(?i).*WIRELINE_N.*|(?i).*MOBILE.*|(?i).*CELL_P.*|(?i).*FAX.*', 0.9),
    ("TELEPHONE_NUMBER", r'(?i)PH|(?i)PH[_]?NUM[BER]?|(?i)PH[_]?NB|(?i)TN', 0.6),
    ("TELEPHONE_NUMBER", r'(?i)TEL_?NUM', 0.85),
    ("TSN", r'(?i).*TSN.*', 1.0),
    ("USERNAME", r'(?i)USER|(?i)SUBMITTER|(?i)username', 1.0),
    ("VIDEO", r'(?i).*VIDEO.*', 1.0),
)

# Every class that a name can show is personal data.
PERSONAL_CLASSES = tuple(dict.fromkeys(name for name, _, _ in NAME_PATTERNS))

# Fixed value: scores below this are not reported.
CLASS_THRESHOLD = 0.4
