"""Patterns, word lists and formats the results depend on.

Everything here is data. Changing an entry changes what the operators return.
"""

# Address noise. Tried in this order at each position; a match becomes one space.
NOISE_PATTERNS = (
    r"HONG\s*KONG\s*SAR",
    r"HONG\s*KONG",
    r"香港特別行政區",
    r"香港特區",
    r"\bNEW\s*KOWLOON\b",
    r"\bKOWLOON\b",
    r"\bNEW\s*TERRITORIES\b",
    r"\bISLANDS\s*DISTRICT\b",
    r"c/?o\s+[^,，]+",
    r"attn[：:.]?\s*[^,，]+",
    r"\b\d{8}\b",
    r"[Ff]ax[：:]?\s*[\d\-]+",
    r"[Tt]el[：:]?\s*[\d\-]+",
    r"[Ee]-?[Mm]ail[：:]?\s*\S+",
    r"\bP\.?O\.?\s*Box\s*\d+",
    r"[\x{1F600}-\x{1FFFF}]",
    r"\u200b|\ufeff|\u00a0",
    r"\broom\s*(?=\d|[A-Z]\d)",
    r"\bflat\s*(?=\d|[A-Z]\d)",
    r"\bunit\s*(?=\d|[A-Z]\d)",
)

# The care-of entry above also eats company suffixes ("CO LTD"); the default rules use this one.
CARE_OF_LOOSE = r"c/?o\s+[^,，]+"
CARE_OF_STRICT = r"\bc/o\s+[^,，]+"

# Fixed value: a run of commas.
COMMA_RUN = r"[,，]\s*[,，]+"

# CJK quotes and brackets and their ASCII forms, position by position.
CJK_MARKS = "「」『』【】"
CJK_MARKS_ASCII = "\"\"''[]"

# Characters stripped from both ends of a cleaned address.
END_MARKS = ",;./-"

# Wrong or old wording -> right wording.
ZH_CORRECTIONS = (
    ("汪角", "旺角"),
    ("佐頓", "佐敦"),
    ("鰂漁涌", "鰂魚涌"),
    ("彌頓", "彌敦"),
    ("九廣鐵路", ""),
)

# Fixed value: characters removed from a zh name before its 2-character windows are taken.
NGRAM_SKIP = r"[\s（）()【】《》\-—,，.。、]"

# Fixed value: an English term.
ENGLISH_TERM = r"[A-Za-z]{3,}"

# Characters a saturated name prefix is extended by (after A-Z and 0-9).
EXPANSION_ZH = "中香大新東南北西美國華亞金星龍興德成富永信安合聯萬恒利康明海"

# Limits of the registry name search.
PREFIX_PAGE_LIMIT = 100
PREFIX_MAX_DEPTH = 6

# Letter prefixes and number range of alphabetic company keys.
KEY_PREFIXES = ("C", "G", "L", "F", "E", "H", "N", "U", "Z", "B", "D")
KEY_PREFIX_RANGE = (1_000_000, 4_000_000)
KEY_NUMERIC_RANGE = (0, 99_999_999)
KEY_FORMAT = "%08d"

# Thresholds and second-tier confidence.
GEOCODE_REVIEW_BELOW = 70.0
TAG_REVIEW_BELOW = 0.8
LABEL_CONFIDENCE = 0.75
MISS_LIMIT = 2000

# Registry response field -> column.
REGISTRY_FIELDS = {
    "Brn": "cr_no",
    "Chinese_Company_Name": "name_zh",
    "English_Company_Name": "name_en",
    "Address_of_Registered_Office": "address_raw",
    "Company_Type": "company_type",
    "Date_of_Incorporation": "date_of_incorporation",
    "Re-domiciliation_Date": "re_domiciliation_date",
}

# Fields compared on re-verification; other names are only lower-cased.
VERIFY_FIELDS = {
    "Brn": "cr_no",
    "Chinese_Company_Name": "name_zh",
    "English_Company_Name": "name_en",
    "Address_of_Registered_Office": "address_raw",
}

# Snapshot header (lower-cased, trimmed) -> column, in order of preference.
HEADER_ALIASES = {
    "companyno": "cr_no",
    "company_no": "cr_no",
    "namechinese": "name_zh",
    "nameenglish": "name_en",
    "address": "address_raw",
    "registeredofficeaddress": "address_raw",
}

# Industry sections (code, zh name, en name), in matching order.
SECTIONS = (
    ("A", "農業、林業及漁業", "Agriculture, Forestry and Fishing"),
    ("B", "採礦及採石", "Mining and Quarrying"),
    ("C", "製造業", "Manufacturing"),
    ("D", "電力、燃氣、蒸汽及空調供應", "Electricity, Gas, Steam and Air Conditioning"),
    ("E", "供水、廢水及廢物處理", "Water Supply, Sewerage and Waste"),
    ("F", "建造業", "Construction"),
    ("G", "批發及零售業", "Wholesale and Retail Trade"),
    ("H", "運輸、倉庫及郵政", "Transport, Storage and Post"),
    ("I", "住宿及膳食服務業", "Accommodation and Food Services"),
    ("J", "資訊及通訊業", "Information and Communications"),
    ("K", "金融及保險業", "Finance and Insurance"),
    ("L", "地產業", "Real Estate"),
    ("M", "專業、科學及技術服務業", "Professional and Technical Services"),
    ("N", "行政及支援服務業", "Administrative and Support Services"),
    ("O", "公共行政、社會保障及強制性社會保險", "Public Administration and Social Security"),
    ("P", "教育業", "Education"),
    ("Q", "人體健康及社會工作活動", "Human Health and Social Work"),
    ("R", "藝術、娛樂及康樂活動", "Arts, Entertainment and Recreation"),
    ("S", "其他服務業", "Other Service Activities"),
)

# How a tag was found.
METHOD_KEYWORD = "keyword"
METHOD_LABEL = "llm"
