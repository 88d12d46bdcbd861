"""Table schemas and fixed dimension values.

Every list marked FIXED VALUES below must equal the values the pipeline was
specified with; they are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Logical table schemas (all columns nullable).
# --------------------------------------------------------------------------

CHAPTERS = T.StructType([
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("chapter_number", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image_count", T.LongType()),
])

DIALOGUES = T.StructType([
    T.StructField("chapter_number", T.LongType()),
    T.StructField("page_number", T.LongType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("gcs_path", T.StringType()),
    T.StructField("extracted_text", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

SPEAKERS = T.StructType([
    T.StructField("chapter_number", T.LongType()),
    T.StructField("page_number", T.LongType()),
    T.StructField("speaker", T.StringType()),
    T.StructField("phrase", T.StringType()),
    T.StructField("luffy_says_it", T.BooleanType()),
    T.StructField("about_luffy", T.BooleanType()),
])

MANIFEST_CHAPTER = T.StructType([
    T.StructField("chapter_number", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image_count", T.LongType()),
    T.StructField("image_urls", T.ArrayType(T.StringType())),
    T.StructField("scraped_at", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("manga", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("total_chapters_available", T.LongType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("chapters", T.ArrayType(MANIFEST_CHAPTER)),
])

LOGS = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("severity", T.StringType()),
    T.StructField("resource", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("labels", T.StructType([
            T.StructField("job_name", T.StringType())])),
    ])),
    T.StructField("text_payload", T.StringType()),
    T.StructField("json_payload", T.StringType()),
])

BUDGET_NOTIFICATION = T.StructType([
    T.StructField("costAmount", T.DoubleType()),
    T.StructField("budgetAmount", T.DoubleType()),
])

MENTION = T.StructType([
    T.StructField("speaker", T.StringType()),
    T.StructField("phrase", T.StringType()),
    T.StructField("luffy_says_it", T.BooleanType()),
    T.StructField("about_luffy", T.BooleanType()),
])

# --------------------------------------------------------------------------
# FIXED VALUES
# --------------------------------------------------------------------------

# Log severity scale, lowest to highest.
SEVERITY_LEVELS = ["DEFAULT", "DEBUG", "INFO", "NOTICE", "WARNING", "ERROR",
                   "CRITICAL", "ALERT", "EMERGENCY"]

# The three pipeline jobs whose logs are routed and analysed.
PIPELINE_JOBS = ["onepiece-scraper-job", "ocr-pipeline-job", "nlp-pipeline-job"]

# Services whose data-access audit logs are routed, and the log-name pattern.
AUDIT_SERVICES = ["bigquery.googleapis.com", "storage.googleapis.com",
                  "secretmanager.googleapis.com"]
AUDIT_LOG_NAME_REGEX = ".*cloudaudit.googleapis.com.*data_access"

# Story-arc dimension: (name, first chapter, last chapter, saga), closed intervals.
ARCS = [
    ("East Blue", 1, 100, "East Blue"),
    ("Arabasta", 101, 216, "Grand Line"),
    ("Skypiea", 217, 302, "Grand Line"),
    ("Water Seven", 303, 441, "Grand Line"),
    ("Thriller Bark", 442, 489, "Grand Line"),
    ("Summit War", 490, 597, "Grand Line"),
    ("Fish-Man Island", 598, 653, "New World"),
    ("Dressrosa", 654, 801, "New World"),
    ("Whole Cake Island", 802, 902, "New World"),
    ("Wano", 903, 1057, "New World"),
    ("Egghead", 1058, 1172, "New World"),
]

# Budget alert thresholds (share of the monthly amount) and default amount.
BUDGET_THRESHOLDS = [0.5, 0.9, 1.0]
MONTHLY_BUDGET_AMOUNT = 50.0

# Storage tiering: (minimum age in days, storage class), checked oldest first.
TIER_RULES = [(90, "COLDLINE"), (30, "NEARLINE")]

# Retention (days): audit log tables and budget messages.
AUDIT_RETENTION_DAYS = 90
BUDGET_MESSAGE_RETENTION_DAYS = 7

# Constants written on every crawled chapter row.
CRAWL_SOURCE = "onepiecescan.fr"
CRAWL_LANGUAGE = "fr"
CRAWL_TITLE = "One Piece"

# Defaults used when a mention object lacks a key.
MENTION_DEFAULTS = {"speaker": "inconnu", "phrase": "", "luffy_says_it": False,
                    "about_luffy": False}

# The tracked phrase.
PHRASE = "roi des pirates"

# Request text sent per page to the mention classifier (SCL-17), verbatim;
# {chapter}, {page}, {text} and {phrase} are filled per row.  With the default
# phrase the rendered text is the one the pipeline sends.
MENTION_REQUEST_TEMPLATE = """Tu es un expert du manga One Piece en français.
Voici le texte extrait par OCR d'une page du manga
(chapitre {chapter}, page {page}).

CONTEXTE IMPORTANT :
- Luffy peut être désigné par : "Luffy", "L", "Lu", "Monkey",
  "Monkey D. Luffy", "le capitaine", "chapeau de paille",
  ou simplement par "je/moi" dans un dialogue
- Le texte OCR est souvent fragmenté — les bulles sont
  séparées par des sauts de ligne
- "luffy_says_it" = true si Luffy exprime lui-même
  sa volonté de devenir {phrase}
  (phrases comme : "je serai", "je vais devenir",
  "ce sera moi", "je deviendrai", "mon rêve")
- "about_luffy" = true si quelqu'un d'autre mentionne
  Luffy comme futur roi, ou si c'est un texte narratif
  décrivant l'objectif de Luffy

TEXTE:
{text}

Trouve TOUTES les occurrences où "{phrase}"
est mentionné dans ce texte.

Réponds UNIQUEMENT en JSON sans markdown :
{
  "mentions": [
    {
      "speaker": "Luffy ou nom du personnage ou narrateur",
      "phrase": "phrase exacte contenant {phrase}",
      "luffy_says_it": true ou false,
      "about_luffy": true ou false
    }
  ]
}

- luffy_says_it = true si Luffy affirme qu'il sera {phrase}
- about_luffy = true si quelqu'un d'autre parle de Luffy comme roi

Si aucune mention claire : {"mentions": []}"""

# First-person cues ("the speaker says it") and aliases of the main character,
# both taken from the classification instructions.
SAYS_CUES = ["je serai", "je vais devenir", "ce sera moi", "je deviendrai",
             "mon rêve"]
ALIASES = ["Luffy", "L", "Lu", "Monkey", "Monkey D. Luffy", "le capitaine",
           "chapeau de paille"]


def arcs_frame(spark: SparkSession, extra: list[tuple] | None = None) -> DataFrame:
    """The interval dimension as a DataFrame (name, lo, hi, family).

    It is a fixed, 11-row dimension (plus optional extra rows), so broadcasting
    it is always safe."""
    rows = list(ARCS) + list(extra or [])
    return spark.createDataFrame(
        rows, "name string, lo bigint, hi bigint, family string")
