"""Fixed values.

Word lists, patterns and rule tables whose exact content decides results, so
they have to be the same wherever the pipeline runs.  Anything that grows with
a deployment (noise words, translation dictionary, rename map, enrichment map,
the label table itself) is a parameter of the operator that uses it instead.
"""

# --- fixed values: text normalisation -------------------------------------

STOP_PHRASES = [
    "please advise", "thanks in advance", "thanks", "urgent", "asap", "help", "pls",
]
CURRENCY_SIGNS = ["$", "€", "£", "¥"]
CURRENCY_CODES = ["usd", "eur", "gbp", "jpy", "cny"]
AMOUNT_MASK = "<AMOUNT>"
CARD_MASK = "<CARD_DIGITS>"
MAX_WORDS = 50

# --- fixed values: garbage gate -------------------------------------------

GARBAGE_SIGNATURES = [
    "triggerdagrunoperator", "informaci", "essere", "archivo", "traduce", "thsi",
    "__ea", "xls_mo", "entonces", "cadence", "muchas", "wie",
]
MOJIBAKE_CHARS = [
    "√", "é", "¨", "π", "„", "ç", "°", "©", "≥", "≠", "ä", "ü", "æ", "Á", "ñ", "≤",
    "Ç", "å", "Ê", "ß", "ò", "Ä", "á", "í", "ó", "ú",
]
GARBAGE_WORDS = [
    "zz", "estan", "informacion", "cliente", "questo", "documento", "della", "parte",
    "español", "inglés", "traduci", "poner", "cosa", "nada", "venta", "tarjeta", "pago",
    "jersey", "bars", "thsi", "comp", "entonces", "cadence", "muchas", "wie", "rt", "ea",
    "xls",
]
MAX_NON_ASCII = 5

# --- fixed values: language routing ---------------------------------------

MAX_NON_ASCII_RATIO = 0.15
RESCUE_MAX_CHARS = 150
TECH_WORDS = [
    "sql", "query", "error", "issue", "problem", "update", "create", "delete", "remove",
    "add", "token", "app", "user", "run", "test", "data", "db", "table", "list", "use",
    "using", "get", "set", "make", "id", "support", "server", "python", "java", "code",
    "script", "api", "rest", "select", "from", "where", "join", "insert", "log", "file",
    "network", "system",
]
LATIN_WORD_PATTERN = "[a-záéíóúñäöüß]+"
UNKNOWN_LANGUAGE = "unknown"

# --- fixed values: routing -------------------------------------------------

ROUTE_THRESHOLD = 0.04
RESCUE_THRESHOLD = 0.01
MAX_OVERLAP = 2
WORD_FEATURES = 50000
CHAR_FEATURES = 40000
RESCUE_FEATURES = 10000
MINING_FEATURES = 20000
INTENT_FEATURES = 80000
PURITY_FEATURES = 5000
OTHER_CATEGORY = "Other/Miscellaneous"
OTHER_SUBCATEGORY_ID = 9999
OTHER_SUBCATEGORY = "Uncategorized Garbage"

# --- fixed values: quality review ------------------------------------------

SAMPLE_PER_LABEL = 5
GOLDEN_CAP = 500
PURITY_SAMPLE = 20000
PURITY_MIN_ROWS = 5
DRIFT_DISTANCE = 0.85
GRADE_COLUMN = "is_correct_mapping (1=Yes, 0=No)"
# (word in prompt, word in subcategory, grade); the first match counts, else 1
GRADE_RULES = [
    ("lounge", "error", 0),
    ("refund", "risk", 1),
    ("dispute", "risk", 1),
    ("api endpoint", "api", 1),
    ("compliance guidelines", "amex", 1),
    ("exchange rate", "amex", 1),
    ("error code 403", "error", 1),
]

# --- fixed values: label curation ------------------------------------------

MAX_LABELS_PER_CATEGORY = 20
ANCHOR_SIMILARITY = 0.20
TRAILING_WORDS = ["And", "Or", "For", "To", "Of", "The", "In", "On"]

# (all of these substrings in the lower-case name, words appended); first match
PATCH_RULES = [
    (["error triage", "stacktrace"], "badrequest conferma poid cdn fail issue"),
    (["data analytics", "algorithm"], "wide weighted operator naming maps brackets"),
    (["human resources"], "candidates park wife spot efforts"),
    (["project management"], "rush teach ongoing phases playbook"),
    (["banking operations"], "aml privileged fins stock"),
    (["financial strategy"], "aml privileged fins stock"),
    (["data analytics", "bigquery"], "bq"),
    (["development practices", "frontend"], "grid browser sugarcoat"),
    (["cloud infrastructure"], "env directory eea"),
    (["business communications", "email"], "conclusion valuable"),
]

# (any of these substrings, suffix); first match.  Names below five words only.
LONG_SUFFIX_RULES = [
    (
        [
            "java", "python", "c++", "react", "angular", "node", "express", "api", "graphql",
            "git", "terraform", "software", "code",
        ],
        "Software Engineering and Architecture",
    ),
    (
        [
            "stacktrace", "exception", "null", "leak", "cpu", "crash", "outage", "bug", "defect",
            "error",
        ],
        "Issue Troubleshooting and Debugging",
    ),
    (
        [
            "sql", "table", "column", "etl", "nosql", "mongodb", "hadoop", "bigquery", "dax",
            "data", "row", "csv",
        ],
        "Database Querying and Analytics",
    ),
    (
        [
            "aws", "kubernetes", "docker", "ci", "cd", "jenkins", "network", "load balancer",
            "gateway", "linux", "system",
        ],
        "Cloud Infrastructure and Deployment",
    ),
    (
        [
            "auth", "rbac", "encryption", "ssl", "vulnerability", "phishing", "compliance", "gdpr",
            "risk", "security",
        ],
        "Security Compliance and Risk Management",
    ),
    (
        [
            "email", "grammar", "translate", "presentation", "documentation", "slack", "message",
            "write", "diagram", "meeting",
        ],
        "Corporate Communications and Drafting",
    ),
    (
        [
            "roi", "budget", "roadmap", "market", "sales", "revenue", "pricing", "finance",
            "treasury", "accounting", "investment", "capital", "ebitda",
        ],
        "Financial Strategy and Market Planning",
    ),
    (
        [
            "agile", "scrum", "ticket", "workflow", "meeting", "release", "qa", "test", "jira",
            "schedule",
        ],
        "Agile Project Management and Testing",
    ),
    (
        [
            "hr", "talent", "attrition", "mentorship", "payroll", "training", "immigration",
            "benefits", "employee",
        ],
        "Human Resources and Talent Management",
    ),
    (
        [
            "amex", "card", "merchant", "offers", "account", "banking",
        ],
        "AMEX Banking and Card Operations",
    ),
    (
        [
            "excel", "chart", "statistics", "pandas", "summarize", "brainstorm", "math", "plot",
            "power bi", "tableau",
        ],
        "Data Analysis and Statistical Processing",
    ),
]
LONG_SUFFIX_DEFAULT = "Operations and Strategic Planning"
LONG_SUFFIX_MIN_WORDS = 5

# The same idea with short suffixes.
SHORT_SUFFIX_RULES = [
    (
        [
            "java", "python", "c++", "react", "angular", "node", "express", "api", "graphql",
            "git", "terraform", "software", "code",
        ],
        "Development Practices",
    ),
    (
        [
            "stacktrace", "exception", "null", "leak", "cpu", "crash", "outage", "bug", "defect",
            "error", "badrequest", "grep",
        ],
        "Error Triage",
    ),
    (
        [
            "sql", "table", "column", "etl", "nosql", "mongodb", "hadoop", "bigquery", "dax",
            "data", "row", "csv",
        ],
        "Data Analytics",
    ),
    (
        [
            "aws", "kubernetes", "docker", "ci", "cd", "jenkins", "network", "load balancer",
            "gateway", "linux", "system", "directory", "remote", "browser",
        ],
        "Cloud Infrastructure",
    ),
    (
        [
            "auth", "rbac", "encryption", "ssl", "vulnerability", "phishing", "compliance", "gdpr",
            "risk", "security", "guard", "otp", "identification",
        ],
        "Security Compliance",
    ),
    (
        [
            "email", "grammar", "translate", "presentation", "documentation", "slack", "message",
            "write", "diagram", "meeting",
        ],
        "Business Communications",
    ),
    (
        [
            "roi", "budget", "roadmap", "market", "sales", "revenue", "pricing", "finance",
            "treasury", "accounting", "investment", "capital", "ebitda", "invoice", "loss",
        ],
        "Financial Strategy",
    ),
    (
        [
            "agile", "scrum", "ticket", "workflow", "meeting", "release", "qa", "test", "jira",
            "schedule", "argument", "rule",
        ],
        "Project Management",
    ),
    (
        [
            "hr", "talent", "attrition", "mentorship", "payroll", "training", "immigration",
            "benefits", "employee", "staff", "admin", "candidate",
        ],
        "Human Resources",
    ),
    (
        [
            "amex", "card", "merchant", "offers", "account", "banking",
        ],
        "Banking Operations",
    ),
    (
        [
            "excel", "chart", "statistics", "pandas", "summarize", "brainstorm", "math", "plot",
            "power bi", "tableau",
        ],
        "Statistical Analysis",
    ),
]
SHORT_SUFFIX_DEFAULT = "Strategic Planning"

# The variant used to name discovered clusters.
CLUSTER_SUFFIX_RULES = [
    (
        [
            "java", "python", "c++", "react", "angular", "node", "express", "api", "graphql",
            "git", "terraform", "software", "code", "script", "deploy", "cdn", "operator",
        ],
        "Development Practices",
    ),
    (
        [
            "stacktrace", "exception", "null", "leak", "cpu", "crash", "outage", "bug", "defect",
            "error", "badrequest", "grep", "fail",
        ],
        "Error Triage",
    ),
    (
        [
            "sql", "table", "column", "etl", "nosql", "mongodb", "hadoop", "bigquery", "dax",
            "data", "row", "csv", "db",
        ],
        "Data Analytics",
    ),
    (
        [
            "aws", "kubernetes", "docker", "ci", "cd", "jenkins", "network", "load balancer",
            "gateway", "linux", "system", "directory", "remote", "browser", "env", "host",
        ],
        "Cloud Infrastructure",
    ),
    (
        [
            "auth", "rbac", "encryption", "ssl", "vulnerability", "phishing", "compliance", "gdpr",
            "risk", "security", "guard", "otp", "identification", "compromise", "aml", "ppe",
        ],
        "Security Compliance",
    ),
    (
        [
            "email", "grammar", "translate", "presentation", "documentation", "slack", "message",
            "write", "diagram", "meeting", "conclusion", "teach", "rush", "summarize",
        ],
        "Business Communications",
    ),
    (
        [
            "roi", "budget", "roadmap", "market", "sales", "revenue", "pricing", "finance",
            "treasury", "accounting", "investment", "capital", "ebitda", "invoice", "loss",
            "stock",
        ],
        "Financial Strategy",
    ),
    (
        [
            "agile", "scrum", "ticket", "workflow", "meeting", "release", "qa", "test", "jira",
            "schedule", "argument", "rule", "playbook", "phases", "ongoing",
        ],
        "Project Management",
    ),
    (
        [
            "hr", "talent", "attrition", "mentorship", "payroll", "training", "immigration",
            "benefits", "employee", "staff", "admin", "candidate", "candidates", "wife", "spot",
        ],
        "Human Resources",
    ),
    (
        [
            "amex", "card", "merchant", "offers", "account", "banking", "fins", "privileged",
        ],
        "Banking Operations",
    ),
    (
        [
            "excel", "chart", "statistics", "pandas", "summarize", "brainstorm", "math", "plot",
            "power bi", "tableau", "grid", "weighted", "maps",
        ],
        "Statistical Analysis",
    ),
]
CLUSTER_PREFIX = "Auto Cluster: "
SHORT_SUFFIXES = [suffix for _, suffix in SHORT_SUFFIX_RULES] + [SHORT_SUFFIX_DEFAULT]

NAME_STOPWORDS = [
    "and", "or", "the", "a", "an", "in", "on", "for", "to", "of", "with", "by", "at", "about",
]

# The widely published English stop list (179 words).
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]

NAME_FIXES = {
    "Sow Statement Of": "Statement of Work (SOW)",
    "Error Getting Debug": "Debugging & Error Logs",
    "Bank Neutral": "Legal & Tribunal Proceedings",
    "Csv Path File": "CSV Data Loading",
    "Amex Software Error": "Software Error Reports",
    "Concurrent Chat Sessions": "Live Chat Concurrency",
    "Tsr Shareholder Trends": "Shareholder Trends (TSR)",
    "Jump Guides": "Knowledge Base & Jump Guides",
    "Monitor Build": "Build Monitoring & DevOps",
    "Eod End Of": "End of Day (EOD) Operations",
    "Amex Award Alternatives": "Employee Awards & Recognition",
    "Code Changes Required": "Code Review & Changes",
    "Jupyter Notebook Club": "Jupyter Notebooks",
    "Script Execution Run": "Script Execution Logs",
    "Python Pandas Numpy": "Python Data Science (Pandas/Numpy)",
    "Diagram Link Visio": "Diagrams & Flowcharts",
    "Big Data Hadoop": "Big Data (Hadoop/Spark)",
    "Pricing Gl Settings": "Pricing & GL Settings",
    "Statistical Problems": "Statistical Analysis",
    "Chart Graph Dashboard": "Dashboards & Visualization",
    "Amazon Brands": "Amazon & Brand Marketing",
    "Brainstorm Ideate Concept": "Concept Ideation",
    "Webex Conferencing": "WebEx & Conferencing",
    "Telesales Operations": "Telesales & Operations",
    "Pilot Project Proposals": "Pilot Projects",
    "Video Creative Assets": "Video & Creative Assets",
    "Compliance Database Tables": "Compliance Data",
    "Bullet Points List": "Presentation Bullet Points",
    "Budget Revenue Profit": "Revenue & Profitability",
    "Csv Uploading Process": "CSV Uploads",
    "Software Engineering & Development": "Software Engineering",
    "Production Support & Debugging": "Production Support",
}

NAME_INJECTIONS = {
    "Software Error Reports":
        "stacktrace exception null traceback pointer segfault error fail line file",
    "Big Data (Hadoop/Spark)": "hadoop spark mapreduce hive kafka streaming pipeline",
    "Debugging & Error Logs": "debug error warning log traceback exception",
    "Code Review & Changes": "git commit push pull request merge conflict diff review",
    "Script Execution Logs": "bash script execution run python java node logs output",
}

TECH_INJECTIONS = {
    "Java Python C++":
        "import def class public private syntax compile method object variable function loop array",
    "Frontend React Angular":
        "html css javascript ui dom jsx hook component state prop npm window document",
    "Backend Node Express":
        "server middleware endpoint route backend npm django flask spring",
    "Api Rest Graphql":
        "api rest graphql json payload endpoint get post put delete request response",
    "Git Version Control":
        "git commit push pull branch merge repository clone pr repository conflict",
    "Stacktrace Exception Null":
        "traceback exception null pointer segfault error fail stacktrace traceback line file",
    "Sql Select Update":
        "sql select from where join group by insert update delete query table database",
    "Big Data Hadoop":
        "hadoop spark mapreduce hive kafka streaming big data pipeline",
    "Kubernetes Docker Container":
        "kubernetes docker container pod cluster k8s image registry orchestration",
    "Ci Cd Jenkins":
        "ci cd jenkins gitlab pipeline deployment build action runner",
    "Terraform Ansible Infrastructure":
        "terraform ansible infrastructure as code yaml playbook configuration",
}
