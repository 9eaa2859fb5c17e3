"""Constants that decide results and therefore must not vary.

Everything here is data.  Operators take these as parameter defaults.
"""

# --- register pages -------------------------------------------------------
REGISTER_ID = r"CHE-\d{3}\.\d{3}\.\d{3}"
REGISTERED_ON = r"Registered on (\d{2}\.\d{2}\.\d{4})"
REGISTERED_ON_FORMAT = "dd.MM.yyyy"
FIRST_YEAR = 1800
LAST_YEAR = 2030
ID_HEADER = "IDI"
LINK_HEADER = "Estratto cantonale"
TITLE_ID = "Titel"
PANEL_ID = "idAuszugForm:auszugContentPanel"
ADDRESS_HEADER = "Registered address"
PURPOSE_HEADER = "Purpose"
STRUCK_CLASS = "strike"
TITLE_FIELDS = ["Ditta", "Forma giuridica", "Sede", "IDI", "Registration_date"]
SECTION_CELLS = 3

# --- contacts -------------------------------------------------------------
PHONE_DIGITS = 10
EMAIL_LOCAL = r"[a-zA-Z0-9._%+-]"
EMAIL_DOMAIN = r"[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL = rf"{EMAIL_LOCAL}+@{EMAIL_DOMAIN}"
WEBSITE_START = r"^(www\.|https?://)"
MAILTO = "mailto:"
CONTACT_COLUMNS = ["Phone Numbers", "Email", "Website"]

# --- text cleaning --------------------------------------------------------
STOP_WORDS = [
    # English
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
    # Italian
    "il", "la", "le", "i", "gli", "e", "o", "ma", "in", "su", "a", "per", "di", "con", "da",
    # German
    "der", "die", "das", "und", "oder", "aber", "in", "auf", "bei", "für", "von", "mit",
    # French
    "le", "la", "les", "et", "ou", "mais", "dans", "sur", "à", "pour", "de", "avec", "par",
]

# Cell texts a CSV scan reads as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- classification -------------------------------------------------------
UNKNOWN = "Other"
MIN_SCORE = 0.5
CATEGORY_HYPOTHESIS = "This is a {} company."
SUBCATEGORY_HYPOTHESIS = "This company is a {}."
MODEL_TEXT = "Company: {name}. Purpose: {purpose}"
MAX_ATTEMPTS = 3
RATE_LIMIT_ERROR = "429"

# --- token and cost estimates ---------------------------------------------
CHARS_PER_TOKEN = 4
REPLY_TOKENS = 20
INPUT_PRICE_PER_1K = 0.000075
OUTPUT_PRICE_PER_1K = 0.0005
FLAT_TOKENS = 300
FLAT_PRICE_PER_1M = 0.15
TALLY_REPLY_TOKENS = 50

# --- sizes ----------------------------------------------------------------
MODEL_BATCH = 4
SINGLE_PROMPT_BATCH = 5
TWO_PROMPT_BATCH = 20
DIRECTORY_BATCH = 50
SINGLE_PROMPT_RATE = 10
TWO_PROMPT_RATE = 500

# --- prompts --------------------------------------------------------------
# {name}, {purpose}, {taxonomy}, {categories}, {category}, {subcategories} are
# the places to fill.
SINGLE_PROMPT = """
            Classify the following company into the most appropriate category and subcategory.
            
            Company Name: "{name}"
            Company Purpose: "{purpose}"

            Available categories and subcategories:
            {taxonomy}

            Consider both the name and purpose of the company. The text might be in Italian, German, or French, 
            but classify it into the English categories provided.

            Important guidelines:
            1. Focus on the main business activity
            2. If multiple categories could apply, choose the most specific one
            3. Return ONLY the category and subcategory in this exact format:
               Category: [category name]
               Subcategory: [subcategory name]

            If no subcategory fits well, use the category name as the subcategory.
            """

ESTIMATE_PROMPT = """
    Classify the following company into the most appropriate category and subcategory.
    
    Company Name: "Sample Company"
    Company Purpose: "Sample Purpose"

    Available categories and subcategories:
    {taxonomy}

    Consider both the name and purpose of the company. The text might be in Italian, German, or French, 
    but classify it into the English categories provided.

    Important guidelines:
    1. Focus on the main business activity
    2. Consider both name and purpose equally
    3. If multiple categories could apply, choose the most specific one
    4. Return ONLY the category and subcategory in this exact format:
       Category: [category name]
       Subcategory: [subcategory name]
    """

CATEGORY_PROMPT = """You are a business classifier. Given the following company information:
Name: {name}
Purpose: {purpose}

You must classify this company into exactly one of these categories:
{categories}

Rules:
1. Choose the most specific category that fits
2. Only respond with one of the listed categories
3. Do not add any explanation or additional text
4. If unsure, choose the closest matching category rather than 'Other'

Respond with only the category name."""

SUBCATEGORY_PROMPT = """You are a business classifier. Given the following company information:
Name: {name}
Purpose: {purpose}
Category: {category}

You must classify this company into exactly one of these subcategories:
{subcategories}

Rules:
1. Choose the most specific subcategory that fits
2. Only respond with one of the listed subcategories
3. Do not add any explanation or additional text
4. If unsure, choose the closest matching subcategory

Respond with only the subcategory name."""

# --- record layouts -------------------------------------------------------
EXTRACT_COLUMNS = [
    "idi", "company_name", "url", "Ditta", "Forma giuridica", "Sede", "IDI",
    "Registration_date", "Registered_address", "Purpose",
]
DIRECTORY_COLUMNS = [
    "Company Name", "IDI", "Address", "Phone Numbers", "Email", "Website", "Detail URL", "Search URL",
]
MAIN_COLUMNS = [
    "Ditta", "Forma giuridica", "Sede", "IDI", "Registration_date", "Registered_address", "Purpose",
    "Address", "Phone Numbers", "Email", "Website", "Category", "Subcategory",
]
COMPANY_COLUMNS = [
    "IDI", "Ditta", "Forma giuridica", "Sede", "Registration_date", "Registered_address", "Purpose",
]
