"""Word lists and patterns. Every function that uses them takes them as a parameter."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------------------------
# Results depend on them being exactly these.
# ---------------------------------------------------------------------------------------------

MISSING = "NA"

META_SOURCE = "ADII"
PARSER_VERSION = "v1.4"
SCHEMA_VERSION = "v1.0"
SCRAPER_NAME = "selenium-scraper"
LANGUAGE = "fr"

SECTION_POSITION = "Position tarifaire"
SECTION_TAXES = "Droits et Taxes"
SECTION_DOCUMENTS = "Documents et Normes"
SECTION_AGREEMENTS = "Accords et Convention"
SECTION_HISTORY = "Historique Droit d'Importation"

DESIGNATION_KEY = "DESIGNATION DU PRODUIT"
SECTION_KEY = "SECTION"
CHAPTER_KEY = "CHAPITRE"

KEY_VALUE_PATTERN = r"([^:]+?)\s*(?:\([^)]*\))?\s*:\s*([^\n]+)"
KEY_VALUE_MAX_LENGTH = 200

METADATA_PATTERNS = {
    "position": r"Position tarifaire\s*:?\s*([^\n<]+)",
    "source": r"Source\s*:?\s*([^\n<]+)",
    "date": r"Situation du\s*:?\s*([^\n<]+)",
    "unit": r"Unité.*?:?\s*([^\n<]+)",
}

# In priority order: a tie goes to the earlier type.
SECTION_TYPE_KEYWORDS = {
    "statistics": [r"\d{4}.*\d{4}", "importation", "exportation", "statistique"],
    "financial": [r"\d+\.?\d*\s*%", "droit", "taxe", "tva"],
    "geography": ["pays", "country", "ue", "agadir", "turquie"],
    "regulatory": ["accord", "restriction", "prohibition", "document", "norme"],
}
SECTION_TYPE_DEFAULT = "general_info"

NAV_SKIP_WORDS = ["nouvelle recherche", "recherche", "retour", "accueil", "home"]

DOCUMENT_CODE = r"^\d{3,5}$"
DOCUMENT_NOISE_LINES = ["AD", "i", "L", "ADII", "Source :", "Situation du :"]

AGREEMENT_RATE = r"^[\d\.\,]+(\s*%)?$"
AGREEMENT_REGIME_WORDS = [
    "FRANCHISE", "DEMANTELEMENT", "ANNEXE", "AGRI", "LISTE", "PAYS MOINS", "PROTOCOLE",
]
AGREEMENT_NOISE_LINES = ["Accords", "Liste", "DI", "( en % )", "TPI", "Source :", "ADII"]
AGREEMENT_NOISE_PARTS = [
    "Position tarifaire", "Situation du", "Accords et Conventions", "(*) Taux du Régime",
]
AGREEMENT_SHORT_NAMES = ["UE", "UK"]

HIERARCHY_START = "Codification"
HIERARCHY_START_ALT = "01.01"

TAX_KEY_SKIP = ["Position tarifaire", "Situation du", "Source", "ADiL"]

TIMESTAMP_NOISE = r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}"
RULER_NOISE = r"[*-]{3,}"

EXPORT_CLEAN_COLUMNS = [
    "hs6_label", "designation", "section_label", "chapter_label", "hs4_label", "hs8_label",
]

ETA_ITEMS = 13_000
REFRESH_DAYS = 25

CODE_FORMATS = {
    "section_code": r"^[0-9]{2}$",
    "chapter_code": r"^[0-9]{2}$",
    "hs4": r"^[0-9]{4}$",
    "hs6": r"^[0-9]{6}$",
    "hs10": r"^[0-9]{10}$",
}

# ---------------------------------------------------------------------------------------------
# Own defaults: no published values exist for these lists; pass others where the site differs.
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Site-dependent word lists and patterns, in Java regex syntax."""

    boilerplate: tuple[str, ...] = (
        "Administration des Douanes et Impôts Indirects",
        "Nouvelle recherche",
        "Imprimer cette page",
    )
    document_keys: tuple[str, ...] = ("DOCUMENTS EXIGES", "Document(s) exigible(s)")
    # ordered (pattern, replacement) pairs for labels
    label_rules: tuple[tuple[str, str], ...] = (
        (r"(?U)^[\s\-–]+", ""),
        (r"(?U)[\s:;]+$", ""),
    )
    section_code: str = r"(?iU)\bSECTION\s*:?\s*(\d{2})\b"
    section_label: str = r"\bSECTION\s*:?\s*{code}\s*-\s*([^\n]*)"
    chapter_code: str = r"(?iU)\bCHAPITRE\s*:?\s*(\d{2})\b"
    chapter_label: str = r"\bCHAPITRE\s*:?\s*{code}\s*-\s*([^\n]*)"
    fallback_split: str = r"(?U)^(\d{1,2})\s*-\s*(.+)$"
    # label starts after the previous item, a stop sign or a digit, so scanning stays linear
    tax_main: str = (
        r"(?U)(?:\G|^|(?<=[():%0-9]))\s*(\**\p{L}[^():%]*?)\s*\(\s*([^():%]+?)\s*\)\s*:\s*"
        r"(\d+(?:[.,]\d+)?(?:\s*%)?)"
    )
    tax_code_from_key: str = r"(?U)\(\s*([^)]+?)\s*\)"
    tax_key_clean: str = r"(?U)^\s*-+\s*"


DEFAULT_RULES = Rules()
