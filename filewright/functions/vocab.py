"""Vocabularies and codes that results depend on, in their published order."""

from __future__ import annotations

# Endings that mark a company but stay in its name.
ENDINGS_KEPT = [
    "DST", "DEVELOPMENT", "HOLDINGS", "HOLDING", "GROUP", "ENTERPRISES", "ENTERPRISE", "SOLUTIONS", "SYSTEMS", "TECHNOLOGIES",
    "TECHNOLOGY", "TECH", "SERVICES", "SERVICE", "CONSULTING", "CONSULTANTS", "PARTNERS", "PARTNERSHIP", "ASSOCIATES", "ASSOCIATION",
    "INTERNATIONAL", "INTL", "GLOBAL", "WORLDWIDE", "NATIONAL", "USA", "US", "AMERICA", "AMERICAN",
]

# Endings that are stripped from a company's name.
ENDINGS_STRIPPED = ["INC", "INCORPORATED", "CORPORATION", "CORP", "COMPANY", "CO", "PTE", "LTD", "LIMITED", "a Delaware limited liability company", "[related person is an entity]"]

# Patterns of legal forms.
LEGAL_FORMS = [
    r"S[., ]{0,2}A[., ]{0,2}R[., ]{0,2}L[., ]{0,2}", r"L[., ]{0,2}L[., ]{0,2}C[., ]{0,2}", "Limited Liability Company", "Limited Liability Partnership",
    r"L[., ]{0,2}L[., ]{0,2}P\.", r"P[., ]{0,2}L[., ]{0,2}L[., ]{0,2}C\.", r"L[., ]{0,2}P[., ]{0,2}", r"G[., ]{0,2}P[., ]{0,2}", r"P[., ]{0,2}C[., ]{0,2}", r"P[., ]{0,2}A[., ]{0,2}",
]

# Names that are replaced as a whole.
RENAMED = {"international business machines": "IBM", "apple": "Apple Computer"}

# Entries of a person's name field that are no name.
BAD_PERSON = [
    "n/a", "na", "Managing Member", "(entity)", "[entity]", "entity", "none", "(none)", "[none]", "-", "--", "---", "----",
    ".", "..", "...", "....", "_", "__", "___", "____", "a Delaware limited liability company",
]

# A word of an address and the state or country code that it tells.
PLACE_CODES = {
    "TORONTO": "A0", "VANCOUVER": "A0", "NORTH VANCOUVER": "A0", "CALGARY": "A0", "KANATA": "A0", "MONTREAL": "A0", "ST-LAURENT": "A0",
    "SAN JUAN": "PR", "RINCON": "PR", "LONDON": "X0", "EDINBURGH": "X0", "MANCHESTER": "X0", "REIGATE": "X0",
    "SHANGHAI": "F4", "BEIJING": "F4", "HANGZHOU": "F4", "GUANGZHOU": "F4", "DONGGUAN": "F4", "XIAMEN": "F4", "SHENZHEN": "F4", "CHENGDU": "F4", "WUHAN": "F4",
    "HONG KONG": "K3", "KOWLOON": "K3", "SINGAPORE": "U0", "GRAND CAYMAN": "E9", "GEORGE TOWN": "E9", "CAMANA BAY": "E9",
    "ZURICH": "V8", "BAAR": "V8", "BASEL": "V8", "ZUG": "V8", "LUXEMBOURG": "N4", "PARIS": "I0", "MUNICH": "2M", "HEPPENHEIM": "2M",
    "MILANO": "L6", "LUCCA": "L6", "THE HAGUE": "P7", "AMSTERDAM": "P7", "OSLO": "Q8", "LYSAKER": "Q8", "HOERSHOLM": "G7", "BUDAPEST": "K5",
    "MIGDAL HAEMEK": "L3", "HERZILIYA PITUACH": "L3", "BNEI BRAK": "L3", "DUBAI": "C0", "ABU DHABI": "C0", "SAU PAULO": "D5", "SAO PAULO": "D5",
    "MEXICO CITY": "O5", "SYDNEY": "C3", "MELBOURNE": "C3", "TOKYO": "M0", "DUBLIN": "L2", "MADRID": "U3", "WARSZAWA": "R9", "BRATISLAVA": "2B",
    "STOCKHOLM": "V7", "NACKA": "V7", "AKTAU": "1P", "KUALA LUMPUR": "N8", "ST. HELIER": "Y9", "ST. PETER PORT": "Y7",
    "NASSAU": "C5", "LYFORD BAHAMAS": "C5", "NEW PROVIDENCE": "C5", "YEREVAN": "1B", "HELSINKI": "H9", "TAMPERE": "H9",
}

# Postal codes of states and territories.
US_STATES = (
    "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY PR VI GU AS MP"
).split()

# The code that filings use for a country, its ISO code and name (those that places above tell; more are a parameter).
COUNTRIES = [
    ("A0", "CA", "Canada"), ("X0", "GB", "United Kingdom"), ("F4", "CN", "China"), ("K3", "HK", "Hong Kong"), ("U0", "SG", "Singapore"), ("E9", "KY", "Cayman Islands"),
    ("V8", "CH", "Switzerland"), ("N4", "LU", "Luxembourg"), ("I0", "FR", "France"), ("2M", "DE", "Germany"), ("L6", "IT", "Italy"), ("P7", "NL", "Netherlands"),
    ("Q8", "NO", "Norway"), ("G7", "DK", "Denmark"), ("K5", "HU", "Hungary"), ("L3", "IL", "Israel"), ("C0", "AE", "United Arab Emirates"), ("D5", "BR", "Brazil"),
    ("O5", "MX", "Mexico"), ("C3", "AU", "Australia"), ("M0", "JP", "Japan"), ("L2", "IE", "Ireland"), ("U3", "ES", "Spain"), ("R9", "PL", "Poland"), ("2B", "SK", "Slovakia"),
    ("V7", "SE", "Sweden"), ("1P", "KZ", "Kazakhstan"), ("N8", "MY", "Malaysia"), ("Y9", "JE", "Jersey"), ("Y7", "GG", "Guernsey"), ("C5", "BS", "Bahamas"),
    ("1B", "AM", "Armenia"), ("H9", "FI", "Finland"),
]

# Items of a current report.
ITEMS_8K = {
    "1.01": "Entry into a Material Definitive Agreement",
    "1.02": "Termination of a Material Definitive Agreement",
    "1.03": "Bankruptcy or Receivership",
    "1.04": "Mine Safety - Reporting of Shutdowns and Patterns of Violations",
    "1.05": "Material Cybersecurity Incidents",
    "2.01": "Completion of Acquisition or Disposition of Assets",
    "2.02": "Results of Operations and Financial Condition",
    "2.03": "Creation of a Direct Financial Obligation or an Obligation under an Off-Balance Sheet Arrangement of a Registrant",
    "2.04": "Triggering Events That Accelerate or Increase a Direct Financial Obligation or an Obligation under an Off-Balance Sheet Arrangement",
    "2.05": "Cost Associated with Exit or Disposal Activities",
    "2.06": "Material Impairments",
    "3.01": "Notice of Delisting or Failure to Satisfy a Continued Listing Rule or Standard; Transfer of Listing",
    "3.02": "Unregistered Sales of Equity Securities",
    "3.03": "Material Modifications to Rights of Security Holders",
    "4.01": "Changes in Registrant's Certifying Accountant",
    "4.02": "Non-Reliance on Previously Issued Financial Statements or a Related Audit Report or Completed Interim Review",
    "5.01": "Changes in Control of Registrant",
    "5.02": "Departure of Directors or Certain Officers; Election of Directors; Appointment of Certain Officers: Compensatory Arrangements of Certain Officers",
    "5.03": "Amendments to Articles of Incorporation or Bylaws; Change in Fiscal Year",
    "5.04": "Temporary Suspension of Trading Under Registrant's Employee Benefit Plans",
    "5.05": "Amendments to the Registrant's Code of Ethics, or Waiver of a Provision of the Code of Ethics",
    "5.06": "Change in Shell Company Status",
    "5.07": "Submission of Matters to a Vote of Security Holders",
    "5.08": "Shareholder Nominations Pursuant to Exchange Act Rule 14a-11",
    "6.01": "ABS Informational and Computational Material",
    "6.02": "Change of Servicer or Trustee",
    "6.03": "Change in Credit Enhancement or Other External Support",
    "6.04": "Failure to Make a Required Distribution",
    "6.05": "Securities Act Updating Disclosure",
    "6.06": "Static Pool",
    "6.10": "Alternative Filings of Asset-Backed Issuers",
    "7.01": "Regulation FD Disclosure",
    "8.01": "Other Events",
    "9.01": "Financial Statements and Exhibits",
}
