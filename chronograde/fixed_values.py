"""Values that are fixed by the workbook format and must match it literally.

Nothing here is logic: sheet name, anchor text, blank markers, payload keys, message texts and the
standard rule set with its closed domains.
"""

# --- fixed values: grid layout -------------------------------------------------------------------
SHEET_NAME = "MASTER"
METRICS_ANCHOR = "[Scope Credit Metrics]"
KEY_COLUMN = 1
FIRST_VALUE_COLUMN = 2
BLANK_MARKERS = ["no data", "n/a", "na"]

# Characters a text cell is trimmed of (the Unicode white space set).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: payload keys ------------------------------------------------------------------
METADATA_KEY = "metadata"
FALLBACK_KEY = "parsed_data"
METRICS_KEY = "scopeCreditMetrics"
INDUSTRY_FIELD = "Industry risk"
SCORE_FIELD = "Industry risk score"
WEIGHT_FIELD = "Industry weight"

# Warehouse column -> workbook label.
ENTITY_FIELDS = {
    "natural_key": "Rated entity",
    "country_of_origin": "Country of origin",
    "sector": "CorporateSector",
    "accounting_principles": "Accounting principles",
    "currency": "Reporting Currency/Units",
    "year_end": "End of business year",
}
PROFILE_FIELDS = {
    "business_risk_profile": "Business risk profile",
    "blended_industry_risk": "(Blended) Industry risk profile",
    "competitive_positioning": "Competitive Positioning",
    "market_share": "Market share",
    "diversification": "Diversification",
    "operating_profitability": "Operating profitability",
    "financial_risk_profile": "Financial risk profile",
    "leverage": "Leverage",
    "interest_cover": "Interest cover",
    "cash_flow_cover": "Cash flow cover",
    "liquidity_notches": "Liquidity",
    "specific_factors_1": "Sector/company-specific factors (1)",
    "specific_factors_2": "Sector/company-specific factors (2)",
    "segmentation_criteria": "Segmentation criteria",
    "rating_methodologies_applied": "Rating methodologies applied",
}

# --- fixed values: stages, states and messages ---------------------------------------------------
STAGE_INITIAL = "1.Initial"
STAGE_EXTRACTION = "2.Extraction"
STAGE_VALIDATION = "3.Validation"
STAGE_LOAD = "4.Load"
STAGE_TRANSFORM = "5.Transform"

MSG_DUPLICATE = "Duplicate file checksum detected"
MSG_NO_YEARS = "Years Not Avaialable"
MSG_ANCHOR_ON_TOP = "Anchor unvailable in the sheet"
MSG_PARSE = "Failed parsing allocation percentage."
MSG_TRANSFORM = "Warehouse transformer script invocation failure"

# --- fixed values: closed domains of the standard rule set ---------------------------------------
GRADES = [
    "AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-",
    "B+", "B", "B-", "CCC", "CC", "C", "SD", "D",
]
SCORES = ["BBB", "BB", "A", "B", "AA", "AAA", ""]
NOTCHES = [
    "+4 notches", "+3 notches", "+2 notches", "+1 notch", "± 0 notches",
    "-1 notch", "-2 notches", "-3 notches", "-4 notches",
]
MONTHS = [
    "December", "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November",
]
SEGMENTATIONS = ["Revenue contribution", "EBITDA contribution", "Other"]
ACCOUNTING = ["IFRS", "US-GAAP", "Local GAAP"]
CURRENCIES = [
    "EUR", "HUF", "USD", "AMD", "AED", "AZN", "BAM", "BGN", "BYN", "CHF", "CZK", "DKK", "GBP",
    "GEL", "HRK", "ISK", "MDL", "MKD", "NGN", "NOK", "PLN", "RMB", "RON", "RSD", "RUB", "SEK",
    "TRY", "UAH",
]
SECTORS = [
    "Automobiles & Parts", "Basic Materials", "Chemicals", "Construction & Materials",
    "Financial Services", "Food & Beverage", "Healthcare", "Industrial Goods & Services", "Media",
    "Oil & Gas", "Personal & Household Goods", "Real Estate", "Retail", "Technology",
    "Telecommunications", "Travel & Leisure", "Utilities",
]
METHODOLOGIES = [
    "General Corporate Rating Methodology",
    "Consumer Products Rating Methodology",
    "Metals and Mining Rating Methodology",
    "Government Related Entities Rating Methodology",
    "Investment Holding Companies Rating Methodology",
    "Retail and Wholesale Rating Methodology",
    "Chemicals Rating Methodology",
    "European Utilities Rating Methodology",
    "Automotive and Commercial Vehicle Manufacturers Rating Methodology",
    "European Automotive Suppliers Rating Methodology",
    "Construction and Construction Materials Rating Methodology",
    "European Real Estate Rating Methodology",
    "Pharmaceutical Companies’ Rating Methodology - Innovative",
    "Pharmaceutical Companies’ Rating Methodology - Generic",
    "European Business and Consumer Services Rating Methodology",
    "Oil and Gas Rating Methodology",
]
INDUSTRIES = [
    "Agribusiness",
    "Automotive and Commercial Vehicle Manufacturers",
    "Automotive Suppliers",
    "Business and Consumer Services: asset-light, unspecialised workforce",
    "Business and Consumer Services: asset-light, specialised workforce",
    "Business and Consumer Services: asset-heavy, unspecialised workforce",
    "Business and Consumer Services: asset-heavy, specialised workforce",
    "Capital Goods",
    "Chemicals: Commodity-focused chemical corporates",
    "Chemicals: Specialty chemical corporates",
    "Construction: Buildings and small civil engineering projects",
    "Construction: Concessions",
    "Construction: Construction materials",
    "Construction: Infrastructure and civil engineering",
    "Consumer Products: Discretionary",
    "Consumer Products: Non-Discretionary",
    "Healthcare: Generic pharmaceuticals",
    "Healthcare: Healthcare Services",
    "Healthcare: Innovative pharmaceuticals",
    "Healthcare: Medical Devices",
    "Leisure and Entertainment",
    "Media",
    "Metals & Mining",
    "Oil&Gas: Refining",
    "Oil&Gas: E&P",
    "Postal Services: Letter Mail",
    "Postal Services: Parcels & Express Logistics",
    "Real Estate: Commercial",
    "Real Estate: Commercial development",
    "Real Estate: Homebuilding",
    "Real Estate: Multifamily",
    "Retail: Discretionary retail",
    "Retail: Non-discretionary retail",
    "Technology: Software and IT Services",
    "Telecommunications",
    "Transportation: Airlines",
    "Transportation: Airports",
    "Transportation: Ferries",
    "Transportation: Rail",
    "Transportation: Road transportation and logistics",
    "Utilities: Non-regulated power generation",
    "Utilities: Quasi-regulated activities",
    "Utilities: Regulated network/grid operators",
    "Utilities: Regulated power generation",
    "Utilities: Regulated water infrastructure",
    "Utilities: Trading activities (retail)",
    "Utilities: Trading activities (wholesale)",
]
COUNTRIES = [
    "Czech Republic", "Federal Republic of Germany", "Federal Republic of Nigeria",
    "French Republic", "Grand Duchy of Luxemburg", "Hellenic Republic", "Hungary", "Ireland",
    "Isle of Man", "Italian Republic", "Kingdom of Belgium", "Kingdom of Denmark",
    "Kingdom of Morocco", "Kingdom of Norway", "Kingdom of Spain", "Kingdom of Sweden",
    "Kingdom of the Netherlands", "People's Republic of China", "Portuguese Republic",
    "Republic of Austria", "Republic of Bulgaria", "Republic of Croatia", "Republic of Cyprus",
    "Republic of Estonia", "Republic of Finland", "Republic of Georgia", "Republic of Latvia",
    "Republic of Lithuania", "Republic of Poland", "Republic of Serbia", "Republic of Slovenia",
    "Republic of Turkey", "Romania", "State of Israel", "Swiss Confederation", "Ukraine",
    "United Arab Emirates", "United Kingdom", "United States of America",
]
