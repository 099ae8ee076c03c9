"""Word lists, lookup tables and thresholds.

They describe the pages (Ukrainian and Russian profile pages), so results depend
on them literally. Everything that is code lives elsewhere.
"""

from html.entities import html5

# --- fixed values: months -------------------------------------------------
MONTHS_GENITIVE_UA = (
    "січня", "лютого", "березня", "квітня", "травня", "червня",
    "липня", "серпня", "вересня", "жовтня", "листопада", "грудня",
)
MONTHS_GENITIVE_RU = (
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
)
MONTH_STEMS_UA = (
    "січ", "лют", "бер", "квіт", "трав", "черв",
    "лип", "серп", "вер", "жовт", "лист", "груд",
)
MONTH_STEMS_RU = (
    "янв", "фев", "мар", "апр", "май", "июн",
    "июл", "авг", "сен", "окт", "ноя", "дек",
)

# --- fixed values: section titles ----------------------------------------
SECTION_WORK = "Досвід роботи"
SECTION_EDUCATION = "Освіта"
SECTION_MORE_EDUCATION = "Додаткова освіта"
SECTION_SKILLS = "Знання і навички"
SECTION_LANGUAGES = "Знання мов"
SECTION_RECOMMENDATIONS = "Рекомендації"
SECTION_MORE_INFO = "Додаткова інформація"
SECTION_CONTACTS = "Контактна інформація"
SECTION_DISABILITY = "Інвалідність"
SECTION_STOPS = (
    SECTION_WORK, SECTION_EDUCATION, SECTION_MORE_EDUCATION, SECTION_SKILLS,
    SECTION_LANGUAGES, SECTION_RECOMMENDATIONS, SECTION_MORE_INFO,
    SECTION_CONTACTS, SECTION_DISABILITY,
)
STRUCTURED_MARKERS = (
    "досвід роботи", "опыт работы", "освіта", "образование",
    "знання і навички", "навыки", "знання мов", "языки",
    "додаткова інформація", "дополнительная информация",
)
BR_ONLY_MIN_COLON_LINES = 5

# --- fixed values: labels --------------------------------------------------
LABELS_CITY = ("Місто проживання", "Місто")
LABELS_EMPLOYMENT = ("Вид зайнятості", "Зайнятість")
LABELS_AGE = ("Вік",)
LABELS_READY = ("Готовий працювати",)
LABELS_CONSIDERED = ("Розглядає посади",)
LABELS_POSITION = ("Посада", "Должность", "Position")

# --- fixed values: limits ----------------------------------------------------
NAME_SCAN_LINES = 12
POSITION_SCAN_LINES = 5
NAME_MAX_WORDS = 3
NAME_MAX_CHARS = 80
POSITION_MAX_CHARS = 120
DATE_SCAN_LINES = 20
SALARY_SCAN_LINES = 40
SALARY_MIN, SALARY_MAX = 1_000, 1_000_000
TITLE_MAX_CHARS = 80
TITLES_KEPT = 20
TITLE_SIMILARITY = 0.82
SKILL_SIMILARITY = 0.78
STORE_PAGE_SIZE, STORE_PAGE_SIZE_MAX = 25, 200

# --- fixed values: other words ----------------------------------------------
UNKNOWN_NAME = "unknown"
PAYLOAD_SCHEMA_VERSION = "resume_payload_v1"
MODE_CONTAINER = "resume_id_block"
MODE_WHOLE_PAGE = "whole_page_fallback"
WARN_NO_CONTAINER = "missing_main_resume_block"
WARN_WHOLE_PAGE = "used_whole_page_fallback"
WARN_NO_NAME = "unknown_person_name"
WARN_PROCESSING = "processing_failed"
PRESENT = "present"

LEGAL_FORMS = (
    "тов", "тзов", "ооо", "пп", "дп", "прat", "пат", "ат", "прат",
    "фоп", "флп", "іп", "упсп", "тоv",
)
LEGAL_FORMS_IN_TAIL = ("ТОВ", "ООО", "ДП", "ПП", "АТ", "ПрАТ", "ФОП")
INSTITUTION_WORDS = ("університет", "інститут", "university", "academy")

# Ordered: the first degree with a matching word wins.
DEGREES = (
    ("незакінчена вища", ("незакінчена", "незакінчен", "неповна вища", "incomplete higher")),
    ("вища", ("вища", "высшее", "higher")),
    ("середня спеціальна", ("середня спеціальна", "среднее специальное", "vocational", "college")),
    ("середня", ("середня", "среднее", "secondary")),
)
LANGUAGE_LEVELS = (
    ("початковий", ("початковий", "beginner", "elementary", "a1", "a2")),
    ("середній", ("середній", "intermediate", "b1")),
    ("вище середнього", ("вище середнього", "upper intermediate", "upper-intermediate", "b2")),
    ("просунутий", ("просунутий", "advanced", "c1")),
    ("вільно", ("вільно", "fluent", "native", "c2")),
)
LICENCE_CLASSES = ("A", "B", "BE", "C", "CE", "D", "DE")

# Named character references of HTML, frequent ones first, and those valid without a semicolon.
FREQUENT_ENTITIES = ("nbsp", "amp", "quot", "lt", "gt", "laquo", "raquo", "ndash", "mdash", "bull", "middot", "hellip")
ENTITIES = {n: html5[f"{n};"] for n in FREQUENT_ENTITIES} | {n[:-1]: c for n, c in html5.items() if n[-1] == ";"}
BARE_ENTITIES = {n: c for n, c in html5.items() if n[-1] != ";"}
# Code points 128 to 159 mean the characters of this code page, where it has one.
C1_CHARACTERS = tuple(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
