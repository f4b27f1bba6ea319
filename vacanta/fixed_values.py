"""Every value that results depend on letter for letter, kept in one place.

Nothing here is computed; the modules that use these values hold the logic.
"""

# --- Fixed values: skill dictionary, category -> skill -> spellings ------------
SKILL_DICTIONARY = {
    "Programming Languages": {
        "Python": ["python"],
        "SQL": ["sql", "t-sql", "pl/sql", "mysql queries"],
        "R": ["r programming", " r,", " r."],
        "Java": ["java"],
        "Scala": ["scala"],
        "JavaScript": ["javascript", "js"],
        "C++": ["c++"],
        "C#": ["c#"],
        "VBA": ["vba"],
        "Bash": ["bash", "shell scripting"],
    },
    "Databases & Warehouses": {
        "PostgreSQL": ["postgresql", "postgres"],
        "MySQL": ["mysql"],
        "SQL Server": ["sql server", "microsoft sql server", "mssql"],
        "Oracle": ["oracle db", "oracle database"],
        "MongoDB": ["mongodb"],
        "Snowflake": ["snowflake"],
        "BigQuery": ["bigquery", "big query"],
        "Redshift": ["redshift"],
        "Databricks": ["databricks"],
    },
    "BI & Visualization": {
        "Power BI": ["power bi", "powerbi"],
        "Tableau": ["tableau"],
        "Looker": ["looker"],
        "Qlik": ["qlik", "qlikview", "qliksense"],
        "Excel": ["excel", "advanced excel"],
        "Google Data Studio": ["data studio", "looker studio"],
    },
    "Cloud Platforms": {
        "AWS": ["aws", "amazon web services"],
        "Azure": ["azure", "microsoft azure"],
        "GCP": ["gcp", "google cloud"],
    },
    "Data Engineering": {
        "Airflow": ["airflow"],
        "dbt": ["dbt", "data build tool"],
        "Spark": ["spark", "pyspark", "apache spark"],
        "Kafka": ["kafka"],
        "Docker": ["docker"],
        "Kubernetes": ["kubernetes", "k8s"],
        "ETL/ELT": ["etl", "elt", "data pipelines"],
        "Git": ["git", "github", "gitlab", "version control"],
        "CI/CD": ["ci/cd", "continuous integration"],
    },
    "Machine Learning & AI": {
        "Machine Learning": ["machine learning", " ml,", " ml.", "ml models"],
        "Deep Learning": ["deep learning", "neural network"],
        "NLP": ["nlp", "natural language processing"],
        "Computer Vision": ["computer vision"],
        "scikit-learn": ["scikit-learn", "sklearn"],
        "TensorFlow": ["tensorflow"],
        "PyTorch": ["pytorch"],
        "LLMs / GenAI": ["llm", "large language model", "generative ai", "genai", "gpt"],
        "MLOps": ["mlops"],
    },
    "Statistics & Analytics Methods": {
        "Statistical Analysis": ["statistical analysis", "statistics", "hypothesis testing"],
        "A/B Testing": ["a/b testing", "ab testing", "experimentation"],
        "Forecasting": ["forecasting", "time series"],
        "Data Modeling": ["data modeling", "data modelling", "dimensional modeling"],
    },
    "Methodology & Soft Skills": {
        "Agile": ["agile", "scrum", "kanban"],
        "Stakeholder Management": ["stakeholder management", "stakeholder engagement"],
        "Communication": ["communication skills", "presentation skills"],
        "Project Management": ["project management"],
    },
    "Qualifications": {
        "Degree Required": ["bachelor's degree", "degree in", "bsc", "msc", "phd"],
        "SC Clearance": ["sc clearance", "security clearance"],
    },
}

# --- Fixed values: title rules, first match wins -------------------------------
ROLE_PATTERNS = [
    ("Machine Learning Engineer", [r"\bml engineer\b", r"machine learning engineer"]),
    ("Data Scientist", [r"data scientist"]),
    ("Analytics Engineer", [r"analytics engineer"]),
    ("Data Engineer", [r"data engineer"]),
    ("Data Architect", [r"data architect"]),
    ("BI Developer / Analyst", [r"\bbi\b", r"business intelligence"]),
    ("Data Analyst", [r"data analyst", r"\banalyst\b"]),
    ("Product Analyst", [r"product analyst"]),
    ("Data Manager / Lead", [r"head of data", r"data manager", r"analytics manager"]),
]
SENIORITY_PATTERNS = [
    ("Head / Director", [r"\bhead of\b", r"\bdirector\b", r"\bvp\b", r"\bchief\b"]),
    ("Lead / Principal", [r"\blead\b", r"\bprincipal\b", r"\bstaff\b"]),
    ("Senior", [r"\bsenior\b", r"\bsr\.?\b"]),
    (
        "Junior / Entry-level",
        [r"\bjunior\b", r"\bjr\.?\b", r"\bgraduate\b", r"\bentry.level\b", r"\bintern\b"],
    ),
]
OTHER_ROLE = "Other"
MID_LEVEL = "Mid-level"
UNSPECIFIED_LEVEL = "Unspecified"

# --- Fixed values: text patterns -------------------------------------------------
BULLET_GLYPHS = "•◦‣▪●·*"
TAB_BULLET = "-\t"
BULLET_REPLACEMENT = "\n- "
BRACKETED_PART = r"[\(\[].*?[\)\]]"
URL_START = r"https?://"

# --- Fixed values: column names --------------------------------------------------
RAW_COLUMNS = [
    "id",
    "title",
    "company",
    "location",
    "region",
    "description",
    "salary_min",
    "salary_max",
    "salary_is_predicted",
    "contract_type",
    "contract_time",
    "category",
    "created",
    "redirect_url",
    "query",
    "collected_at",
]
REQUIRED_COLUMNS = ["title", "description"]
FILTER_COLUMNS = ["role_category", "seniority", "location", "region", "contract_type"]
CATEGORICAL_FEATURES = ["role_category", "seniority", "region", "contract_type", "contract_time"]
SKILL_SEPARATOR = "|"

# --- Fixed values: numeric bounds and defaults -----------------------------------
SALARY_FLOOR = 15_000
SALARY_CEILING = 250_000
HISTOGRAM_BUCKETS = 24
PAY_BY_SKILL_MIN_POSTINGS = 5
PAY_BY_SKILL_LIMIT = 12
TOP_LOCATIONS = 10
SKILL_LIMIT_DEFAULT, SKILL_LIMIT_MAX = 20, 100
POSTINGS_LIMIT_DEFAULT, POSTINGS_LIMIT_MAX = 50, 200
CARD_SKILLS = 8
TREND_SKILLS_MAX = 8
TREND_SKILLS_DEFAULT = 4
UNKNOWN_LABEL = "Unknown"
OTHER_CATEGORY = "Other"
SPLIT_SEED = 42
HOLDOUT_PERCENT = 20
CV_FOLDS = 5
MIN_TRAINING_ROWS = 40
INTERVAL_LOG_SPREAD = 0.35
REQUEST_TEXT_LIMITS = {
    "role_category": 120,
    "seniority": 120,
    "region": 120,
    "contract_type": 60,
    "contract_time": 60,
}
REQUEST_SKILLS_MAX = 60
REQUEST_LENGTH_MAX = 50_000
REQUEST_LENGTH_DEFAULT = 1200
