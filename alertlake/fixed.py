"""Fixed values.

Everything in this module is a value that must equal the behaviour being
reproduced for results to match: word lists, lookup tables, defaults,
formats.  They are stated plainly, in their natural order.  Users override
them by passing their own dimensions (see ``alertlake.sources.dims``).
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — offer table contract
# ---------------------------------------------------------------------------

OFFER_COLUMNS = [
    "ID", "Traite", "Date_decouverte", "Source", "Titre", "Entreprise",
    "Cle_dedup", "Doublon_ID", "Ville", "Dept", "Type_contrat",
    "Salaire_min", "Salaire_max", "URL", "URL_qualite", "URL_redirect", "Stack",
    "Raison_exclusion", "Date_candidature", "Notes", "Message_ID",
]

RAW_OFFER_FIELDS = [
    "titre", "entreprise", "ville", "dept", "type_contrat",
    "salaire_min", "salaire_max", "url", "url_qualite", "notes",
]

ID_PREFIX = "E"
ID_FORMAT = "E%06d"

STATUSES = ["PENDING", "OK", "PARTIEL", "ERREUR", "IGNORE"]
SENTINEL_SOURCE_IDS = ["before_gmail_api", "manual"]

CSV_SEPARATOR = ";"

RUN_HISTORY_COLUMNS = [
    "Date_run", "Fichiers_traites", "Offres_extraites", "Doublons",
    "Ignores", "Erreurs", "Dry_run",
]

# Low-watermark margin for incremental ingest, in hours.
OVERLAP_MARGIN_HOURS = 6
# Safety cap of the "mark processed" step.
MAX_MESSAGES_PER_RUN = 200
# Local zone of the mailbox owner.
LOCAL_TZ = "Europe/Paris"

# Dedup-key placeholders for empty company / city / title.
KEY_EMPTY_COMPANY = "inconnu"
KEY_EMPTY_CITY = "inconnue"
KEY_EMPTY_TITLE = "inconnu"

SLUG_MAX_LEN = 25
SUBJECT_SLUG_MAX_LEN = 40
SUBJECT_SLUG_EMPTY = "sans-sujet"

BLACKLIST_NOTE_PREFIX = "⛔ Blacklisté: "
BLACKLIST_REASON_PREFIX = "Blacklisté: "

# ---------------------------------------------------------------------------
# FIXED VALUES — title slug stop words
# ---------------------------------------------------------------------------

TITLE_STOPWORDS = [
    "le", "la", "les", "un", "une", "des", "du", "de", "d", "l", "en", "et",
    "ou", "sur", "pour", "par", "avec", "sans", "au", "aux", "ce", "cet",
    "cette", "ces", "senior", "junior", "jr", "sr",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — HTML entity replacements, applied in this order
# ---------------------------------------------------------------------------

HTML_ENTITIES = [
    ("&amp;", "&"),
    ("&nbsp;", " "),
    ("&#x27;", "'"),
    ("&#39;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&hellip;", "…"),
    ("&middot;", "·"),
    ("&emsp;", " "),
    ("&#8202;", ""),
    ("&#8203;", ""),
    ("&#8199;", ""),
    ("&#847;", ""),
    ("&shy;", ""),
    ("&#x3D;", "="),
]

# Apostrophe variants folded to "'" before blacklist matching.
APOSTROPHE_VARIANTS = "‘’‚‛ʼ′"

# ---------------------------------------------------------------------------
# FIXED VALUES — technology tags: canonical name -> variations (config order)
# ---------------------------------------------------------------------------

STACK_KEYWORDS = {
    "PHP": ["php"],
    "Symfony": ["symfony"],
    "Laravel": ["laravel"],
    "WordPress": ["wordpress", "word press"],
    "Drupal": ["drupal"],
    "Python": ["python"],
    "Django": ["django"],
    "Flask": ["flask"],
    "FastAPI": ["fastapi", "fast api", "fast-api"],
    "Java": ["java"],
    "C#": ["c#", "csharp", "c sharp"],
    "C++": ["c++", "cpp"],
    ".Net": [".net", "dotnet", "dot net", "asp.net"],
    "JS": ["javascript", "js"],
    "TypeScript": ["typescript"],
    "Node.js": ["node.js", "nodejs", "node js"],
    "Express.js": ["express.js", "expressjs", "express"],
    "React": ["react", "react.js", "reactjs"],
    "Vue.js": ["vue.js", "vuejs", "vue js", "vuejs"],
    "Angular": ["angular", "angularjs"],
    "Next.js": ["next.js", "nextjs", "next js"],
    "Nuxt.js": ["nuxt.js", "nuxtjs", "nuxt js"],
    "jQuery": ["jquery"],
    "HTML": ["html", "html5"],
    "CSS": ["css", "css3", "scss", "sass"],
    "SQL": ["sql"],
    "MySQL": ["mysql"],
    "PostgreSQL": ["postgresql", "postgres"],
    "MongoDB": ["mongodb", "mongo db"],
    "Redis": ["redis"],
    "MariaDB": ["mariadb"],
    "Elasticsearch": ["elasticsearch", "elastic search"],
    "Docker": ["docker"],
    "Kubernetes": ["kubernetes", "k8s"],
    "Git": ["git"],
    "REST API": ["rest api", "restful", "api rest"],
    "GraphQL": ["graphql"],
    "AWS": ["aws", "amazon web services"],
    "Azure": ["azure"],
    "Linux": ["linux"],
    "CI/CD": ["ci/cd", "cicd", "gitlab ci", "github actions"],
    "Fullstack": ["full-stack", "fullstack", "full stack"],
    "Frontend": ["front-end", "frontend", "front end"],
    "Backend": ["back-end", "backend", "back end"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES — city -> département (config order; keys as configured)
# ---------------------------------------------------------------------------

CITY_DEPT = [
    ("toulon", "83"), ("la garde", "83"), ("la seyne-sur-mer", "83"),
    ("la seyne sur mer", "83"), ("hyeres", "83"), ("hyères", "83"),
    ("brignoles", "83"), ("six-fours-les-plages", "83"),
    ("six fours les plages", "83"), ("ollioules", "83"),
    ("la valette-du-var", "83"), ("la valette du var", "83"),
    ("sanary-sur-mer", "83"), ("sanary sur mer", "83"), ("sollies-pont", "83"),
    ("solliès-pont", "83"), ("la farlede", "83"), ("la farlède", "83"),
    ("gemenos", "13"), ("gémenos", "13"), ("marseille", "13"),
    ("aix-en-provence", "13"), ("aix en provence", "13"), ("la ciotat", "13"),
    ("aubagne", "13"), ("miramas", "13"), ("nice", "06"), ("cannes", "06"),
    ("antibes", "06"), ("sophia antipolis", "06"), ("valbonne", "06"),
    ("grasse", "06"), ("montpellier", "34"), ("lyon", "69"), ("paris", "75"),
    ("bordeaux", "33"), ("le bouscat", "33"), ("toulouse", "31"),
    ("nantes", "44"), ("saint-jacques-de-la-lande", "35"), ("rennes", "35"),
    ("strasbourg", "67"), ("lille", "59"), ("marcq-en-baroeul", "59"),
    ("marcq-en-barœul", "59"), ("fretin", "59"), ("grenoble", "38"),
    ("rouen", "76"), ("cléon", "76"), ("cleon", "76"), ("caen", "14"),
    ("bourguébus", "14"), ("bourquebus", "14"), ("avignon", "84"),
    ("metz", "57"), ("nancy", "54"), ("dijon", "21"), ("angers", "49"),
    ("tours", "37"), ("poitiers", "86"), ("limoges", "87"), ("brest", "29"),
    ("clermont-ferrand", "63"), ("perpignan", "66"), ("reims", "51"),
    ("amiens", "80"), ("le mans", "72"), ("meudon", "92"),
    ("levallois-perret", "92"), ("villeneuve-la-garenne", "92"),
    ("montreuil", "93"), ("paulhan", "34"), ("saint-geours-de-maremne", "40"),
    ("saumur", "49"), ("saint-apollinaire", "21"), ("louhans", "71"),
    ("chalon-sur-saone", "71"), ("chalon-sur-saône", "71"), ("noumea", "98"),
    ("nouméa", "98"), ("montrouge", "92"), ("boulogne-billancourt", "92"),
    ("nanterre", "92"), ("vincennes", "94"), ("villejuif", "94"),
    ("ivry-sur-seine", "94"), ("créteil", "94"), ("creteil", "94"),
    ("versailles", "78"), ("saint-quentin-en-yvelines", "78"),
    ("issy-les-moulineaux", "92"), ("le plessis-robinson", "92"),
    ("sophia-antipolis", "06"), ("mougins", "06"), ("biot", "06"),
    ("villeneuve-loubet", "06"), ("la teste-de-buch", "33"), ("merignac", "33"),
    ("mérignac", "33"), ("pessac", "33"), ("talence", "33"), ("mulhouse", "68"),
    ("colmar", "68"), ("montbéliard", "25"), ("belfort", "90"),
    ("besancon", "25"), ("besançon", "25"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — title blacklist (list order = priority)
# ---------------------------------------------------------------------------

TITLE_BLACKLIST = [
    "nounou",
    "auxiliaire de vie",
    "aide à domicile",
    "garde d'enfant",
    "babysitter",
    "mandataire immobilier",
    "commercial immobilier",
    "indépendant immobilier",
    "néggociateur immobilier",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — providers (config order): key, folder, sender domains, skip
# ---------------------------------------------------------------------------

PROVIDERS = [
    ("indeed_alerte", "indeed", ["jobalert.indeed.com", "indeed.com"], False),
    ("indeed_match", "indeed", ["match.indeed.com"], False),
    ("linkedin", "linkedin", ["linkedin.com"], False),
    ("meteojob_company", "meteojob", ["meteojob.com"], False),
    ("meteojob_digest", "meteojob", ["meteojob.com"], True),
    ("talent_com", "talent-com", ["alerts.talent.com", "talent.com"], False),
    ("france_travail", "france-travail", ["offre.francetravail.fr", "francetravail.fr"], False),
    ("jobijoba_alerte", "jobijoba", ["jobijoba.com"], False),
    ("jobijoba_digest", "jobijoba", ["jobijoba.com"], True),
    ("hellowork", "hellowork", ["hellowork.com"], False),
]

# Display name written to the Source column (unknown keys show the key).
SOURCE_DISPLAY = {
    "france_travail": "France Travail",
    "indeed_alerte": "Indeed",
    "indeed_match": "Indeed",
    "linkedin": "LinkedIn",
    "meteojob_company": "Meteojob",
    "jobijoba_alerte": "Jobijoba",
    "talent_com": "Talent.com",
}

# Providers that have an extraction job (others are IGNORE).
EXTRACTABLE_PROVIDERS = [
    "france_travail", "indeed_alerte", "indeed_match", "linkedin",
    "meteojob_company", "jobijoba_alerte", "talent_com",
]

# Contract-type vocabulary per provider, in match-priority order.
CONTRACT_TERMS = {
    "france_travail": ["CDI", "CDD", "Alternance", "Stage", "Freelance", "Intérim", "Apprentissage"],
    "indeed_alerte": ["CDI", "CDD", "Alternance", "Stage", "Freelance", "Intérim"],
    "indeed_match": ["CDI", "CDD", "Alternance", "Stage", "Freelance", "Intérim"],
    "linkedin": ["CDI", "CDD", "Alternance", "Stage", "Freelance"],
    "meteojob_company": ["CDI", "CDD", "Alternance", "Stage", "Freelance", "Intérim"],
    "jobijoba_alerte": ["CDI", "CDD", "Alternance", "Stage", "Freelance", "Indépendant", "Intérim"],
    "talent_com": ["CDI", "CDD", "Alternance", "Stage", "Freelance", "Indépendant"],
}

# Footer links of one provider that look like offer titles.
TALENT_FOOTER_TITLES = [
    "contactez-nous",
    "politique de confidentialité",
    "politique sur les cookies",
    "conditions d'utilisation",
    "plus d'offres",
    "contact us",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "condiciones de uso",
    "política de privacidad",
    "política de cookies",
    "contáctanos",
    "condizioni di servizio",
    "informativa sulla privacy",
    "informativa sui cookie",
    "contattaci!",
    "servicevoorwaarden",
    "privacybeleid",
    "cookiebeleid",
    "neem contact met ons op",
    "nutzungsbedingungen",
    "datenschutzerklärung",
    "cookie-richtlinie",
    "kontakt",
]
TALENT_MAX_ANCHORS = 20

# Canonical mail file name: yyyyMMdd-HHmm-<stem>[_n].eml
CANONICAL_NAME_PREFIX_RE = r"^\d{8}-\d{4}-"

# Zone names of the old mail date format and their offsets.
ZONE_OFFSETS = [("Z", "+0000"), ("UT", "+0000"), ("UTC", "+0000"), ("GMT", "+0000"), ("EST", "-0500"), ("EDT", "-0400"),
                ("CST", "-0600"), ("CDT", "-0500"), ("MST", "-0700"), ("MDT", "-0600"), ("PST", "-0800"), ("PDT", "-0700")]
# Published columns that a sheet must keep as text.
FORCE_TEXT_COLUMNS = ("Source", "Dept")
