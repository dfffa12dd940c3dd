"""Word lists, patterns and site formats that results depend on.

They are data, not logic: changing one changes what the operators return.
Patterns are in Java syntax. ``(?iudU)`` is "ignore case, Unicode classes,
only a line feed ends a line"; ``s`` lets a dot cross lines.
"""

# Words that never become keywords.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "been", "but", "by", "for", "from", "has", "have",
    "he", "her", "his", "i", "if", "in", "is", "it", "its", "just", "me", "my", "not", "of", "on",
    "or", "our", "so", "that", "the", "their", "them", "they", "this", "to", "too", "was", "we",
    "were", "what", "when", "which", "who", "will", "with", "you", "your",
]

# Author names that stand for "no author".
NO_AUTHOR = ["[deleted]", "None"]
DELETED = "[deleted]"

# Close-price column names, in order of preference.
CLOSE_NAMES = ["Close", "Adj Close", "close", "adj_close"]

# County names accepted in documents.
COUNTIES = [
    "mckenzie", "williams", "mountrail", "dunn", "burke", "divide",
    "bottineau", "renville", "ward", "mclean", "mercer", "oliver",
    "morton", "stark", "billings", "golden valley", "slope", "bowman",
    "adams", "hettinger", "grant", "sioux", "emmons", "burleigh",
    "kidder", "stutsman", "wells", "sheridan", "foster", "eddy",
    "benson", "ramsey", "nelson", "griggs", "steele", "traill",
    "cass", "barnes", "ransom", "richland", "sargent", "dickey",
    "lamoure", "logan", "mcintosh", "mchenry", "pierce", "rolette",
    "towner", "cavalier", "pembina", "walsh", "grand forks",
]

# A value counts as a company name if it contains one of these.
COMPANY_WORDS = [
    "company", "inc", "corp", "llc", "petroleum", "oil",
    "energy", "resources", "exploration", "oasis", "continental",
    "slawson", "whiting", "hess", "marathon", "statoil", "burlington",
    "conocophillips", "eog", "qep", "sm energy", "liberty",
]

# Formation names, most specific first.
FORMATIONS = [
    "middle bakken", "bakken", "three forks", "lodgepole",
    "mission canyon", "duperow", "birdbear", "nisku",
]

# Words that follow "Field" in forms without being a field name.
NOT_A_FIELD_ON_FORM = ["inspector", "pool", "gas", "oil", "well", "poo"]
NOT_A_FIELD_ON_APPROVAL = ["inspector", "pool", "gas", "oil", "well"]

# Coordinates: degree, minute and second marks, and the plausible ranges.
DMS_LEADING = (
    r"(?iudU)([NSEW])\s*(\d{2,3})\s*[°˚º]\s*(\d{1,2})\s*"
    r"['‘’′]\s*([\d.]+)\s*[\"“”″]*"
)
DMS_TRAILING = (
    r"(?iudU)(\d{2,3})\s*[°˚º]\s*(\d{1,2})\s*"
    r"['‘’′]\s*([\d.]+)\s*[\"“”″]*\s*([NSEW])"
)
DECIMAL_COORDINATE = r"(?dU)(?:Lat(?:itude)?|Lon(?:gitude)?)\s*[:=]?\s*(-?\d{2,3}\.\d{3,})"
LATITUDE_RANGE = (45, 50)
LONGITUDE_RANGE = (100, 106)

# Incident report, "key: value" lines.
REPORT_OPERATOR = r"(?iudU)Well\s*Operator\s*:\s*(.+)"
REPORT_NAME = r"(?iudU)(?:Well\s*(?:or\s*)?Facility\s*Name|Well\s*Name)\s*:\s*(.+)"
REPORT_FILE_NUMBER = r"(?iudU)NDIC\s*(?:File\s*)?(?:Number|No\.?|#)\s*:\s*(\d+)"
REPORT_FIELD = r"(?iudU)Field\s*Name\s*:\s*([A-Z][A-Za-z ]+)"
REPORT_COUNTY = r"(?iudU)County\s*:\s*([A-Z][A-Za-z ]+)"
REPORT_SECTION = r"(?iudU)Section\s*:\s*(\d+)"
REPORT_TOWNSHIP = r"(?iudU)Township\s*:\s*(\d+N?)"
REPORT_RANGE = r"(?iudU)Range\s*:\s*(\d+W?)"

# Directional survey.
SURVEY_API = r"(?iudU)API\s*(?:Number|#|No)?\s*[:=]?\s*(33[-\s]?\d{3}[-\s]?\d{5})"
SURVEY_API_BARE = r"(?dU)\b(33-\d{3}-\d{5})\b"

# Completion form, values on the line below their label.
FORM_NAME = (
    r"(?iudU)Well\s*Name\s*(?:and\s*Number)?\s*[\|\[\]]*\s*(?:Spacing[^\n]*)?\n"
    r"\s*([A-Z][A-Z0-9\- ]+\d+[A-Z]*H?\b)"
)
FORM_OPERATOR = r"(?iudU)Operator\s*(?:Telephone[^\n]*)?\n\s*(.+)"
FORM_QUARTERS = (
    r"(?dU)(?:SESE|SWSE|SESW|SWSW|NWSE|NWSW|NWNE|NENE|SENW|NESW|NENW|SWNW)"
    r"\s+(\d+)\s+(\d+)\s*N?\s+(\d+)\s*W?"
)
FORM_DASHED = r"(?dU)(\d+)-(\d+)N-(\d+)W"
FORM_COUNTY = r"(?iudU)\b({names})\s*county\b|County\s*[:|\n]\s*({names})\b"
FORM_FIELD = r"(?dU)Field\s*(?:Name)?\s*\n\s*([A-Z][A-Z ]+)\b"

# Verbal approval.
APPROVAL_NAME = r"(?iudU)Well\s*Name\s*Inspector\n\s*([A-Z][A-Z0-9\- ]+\d[A-Z]*H?\b)"
APPROVAL_OPERATOR = (
    r"(?iudU)OPERATOR\s*\n\s*Operator\s*Representative.*\n"
    r"\s*([A-Z][A-Z &,.\-]+(?:INC|LLC|COMPANY|CORP))"
)
APPROVAL_FIELD = r"(?dU)Field\s*\n\s*\d+\s+Feet.*\n\s*([A-Z][A-Z ]+)\b"

# Document name -> file number.
NAME_FILE_NUMBER = r"(?dU)W(\d+)"

# Treatment section of a completion report and its values.
TREATMENT_SECTION = (
    r"(?isudU)(?:Well\s*Specific\s*)?Stimulat.*?(?=CORES\s*CUT|Drill\s*Stem\s*Test|$)"
)
TREATMENT_FORMATION = (
    r"(?iudU)Stimulated?\s*Formation?\s*[:\n|]+\s*([A-Za-z ]+?)"
    r"(?:\s*(?:\d|Top|Bottom|Stimulat|Volume|$))"
)
TREATMENT_TYPE = r"(?iudU)(?:Sand\s*Frac|Acid(?:izing)?|Frac(?:ture)?|Hybrid|Sliding\s*Sleeve)"
TREATMENT_STAGES = r"(?iudU)(?:Stimulation\s*)?Stages?\s*[:\|\[\]]*\s*(\d+)"
TREATMENT_VOLUME = r"(?iudU)(\d{3,})\s*(?:_+\s*)?(?:Barrels|bbls?|gallons)"
TREATMENT_UNITS = r"(?iudU)(Barrels|Gallons)"
TREATMENT_PROPPANT = [
    r"(?iudU)(?:Lbs|Pounds?)\s*Proppant\s*[:\|\[\]]*\s*([\d,]+)",
    r"(?iudU)(?:Sand\s*Frac|Acid|Frac)\s+[\d.]+\s*%?\s*([\d,]{4,})",
    r"(?iudU)([\d,]{5,})(?:\s*#|\s*(?:of|lbs?|pounds?))",
]
TREATMENT_PRESSURE = [
    r"(?iudU)(?:Maximum\s*)?(?:Treatment\s*)?Pressure\s*\(?PSI?\)?\s*[:\|\[\]]*\s*([\d,]+)",
    r"(?dU)(\d{4,})\s*(?:PSI|psi)",
]
TREATMENT_RATE = (
    r"(?iudU)(?:Maximum\s*)?(?:Treatment\s*)?Rate\s*\(?(?:BBLS?|BBL)\s*/\s*Min\)?"
    r"\s*[:\|\[\]]*\s*([\d,.]+)"
)
TREATMENT_DEPTHS = (
    r"(?iudU)Top\s*\(?Ft?\)?\s*[:\|\[\]]*\s*Bottom.*?\n[^\n]*?"
    r"(\d{4,})\s*[\|\[\]\s]+\s*(\d{4,})"
)

# Key/value pages: label (lower case), output column, longest value kept.
PAGE_LABELS = [
    ("well status", "well_status", 100),
    ("well type", "well_type", 100),
    ("closest city", "closest_city", 200),
    ("total oil", "oil_produced", 100),
    ("total gas", "gas_produced", 100),
]
PAGE_TEXT_PATTERNS = {
    "well_status": r"(?dU)Well\s*Status\s*\n?\s*(.+?)(?:\n|Well\s*Type)",
    "well_type": r"(?dU)Well\s*Type\s*\n?\s*(.+?)(?:\n|Township)",
    "closest_city": r"(?dU)Closest\s*City\s*\n?\s*(.+?)(?:\n|Latitude)",
    "oil_produced": r"(?dU)Total\s*Oil\s*Prod\s*\n?\s*([\d,]+)",
    "gas_produced": r"(?dU)Total\s*Gas\s*Prod\s*\n?\s*([\d,]+)",
}
HIDDEN_VALUE = "members only"

# Page addresses.
FORUM_BASE = "https://old.reddit.com"
FORUM_JSON_BASE = "https://www.reddit.com"
ARTICLE_BASE = "https://pubmed.ncbi.nlm.nih.gov/"
WELL_BASE = "https://www.drillingedge.com"
WELL_STATE = "north-dakota"
WELL_NAME_TAIL = r"(?iudU)\s+(?:Well File No|Directional|Number:?).*"
DEFAULT_COUNTY_SLUG = "mckenzie-county"
COUNTY_SLUGS = {
    "williams": "williams-county",
    "mountrail": "mountrail-county",
    "dunn": "dunn-county",
}
