"""Fixed values.

Word lists, lookup tables, labels and column contracts that have to be exactly these for the
results to be right.  They are facts of the data domain, not logic, and every operator takes them
as an argument, so a caller can pass other ones.
"""

# --- column contracts (fixed values) ---------------------------------------------------------

RAW_COLUMNS = (
    "source", "url", "job_id", "search_term", "title", "company", "location_raw", "posted_date",
    "employment_type", "workload_raw", "salary_raw", "description_raw",
    "scraped_at", "canton", "seniority", "description_clean", "skills", "skill_count",
    "salary_available",
)

CLEAN_COLUMNS = (
    "job_id", "title", "company", "role", "location_raw", "city", "canton", "region",
    "posted_date", "quarter", "macro_quarter", "seniority", "workload_min", "workload_max",
    "salary_available", "salary_min", "salary_max", "skills", "skill_count", "description",
)

MERGED_COLUMNS = (
    "job_id", "title", "company", "role", "seniority", "city", "canton", "region",
    "posted_date", "quarter", "macro_quarter", "workload_min", "workload_max",
    "salary_available", "salary_min", "salary_max", "skills", "skill_count",
    "industry", "macro_vacancies_region", "macro_vacancies_industry", "description",
)

PREVIEW_COLUMNS = (
    "title", "company", "role", "seniority", "canton", "region", "city", "industry",
    "skill_count", "salary_available",
)

DEFAULT_ROLES = (
    "data scientist", "data analyst", "machine learning engineer", "data engineer", "ai engineer",
)

SENIORITY_LEVELS = ("intern", "junior", "mid", "senior", "lead")

WORKLOAD_LABELS = {
    "analysis": ("Full-time (≥90%)", "Flexible (61-89%)", "Part-time (≤60%)", "Unknown"),
    "dashboard": ("Full-time (>=90%)", "Flexible (61-89%)", "Part-time (<=60%)", "Unknown"),
}

DEFAULT_INDUSTRY = "62-63 IT services"

# --- skill dictionary (fixed values) ---------------------------------------------------------

SKILL_TERMS = (
    # programming
    "python", "r", "sql", "scala", "java", "c++", "bash", "rust",
    # python ecosystem
    "pandas", "numpy", "scipy", "scikit-learn", "sklearn", "polars", "jupyter", "pydantic",
    "fastapi",
    # machine learning
    "machine learning", "deep learning", "artificial intelligence", "tensorflow", "keras",
    "pytorch", "xgboost", "lightgbm", "catboost", "random forest", "gradient boosting",
    "feature engineering", "transfer learning", "reinforcement learning",
    # generative models
    "llm", "large language model", "generative ai", "gen ai", "gpt", "claude", "gemini", "llama",
    "mistral", "prompt engineering", "rag", "retrieval augmented generation", "langchain",
    "llamaindex", "hugging face", "transformers", "fine-tuning", "lora", "qlora", "ai agents",
    "agentic", "autonomous agents", "vector database", "vector store", "embeddings", "pinecone",
    "weaviate", "chroma", "qdrant",
    # language processing
    "nlp", "natural language processing", "bert", "t5", "text classification",
    "named entity recognition", "ner", "sentiment analysis", "semantic search",
    # vision
    "computer vision", "image recognition", "object detection", "opencv", "yolo",
    "diffusion models", "multimodal",
    # statistics
    "statistics", "regression", "classification", "clustering", "time series", "forecasting",
    "hypothesis testing", "a/b testing", "bayesian",
    # model operations
    "mlops", "ml ops", "model deployment", "model serving", "model monitoring", "model drift",
    "ci/cd", "mlflow", "weights & biases", "wandb", "bentoml", "seldon", "kubeflow", "sagemaker",
    "vertex ai",
    # data engineering
    "etl", "elt", "data pipeline", "data pipelines", "data engineering", "spark", "pyspark",
    "hadoop", "kafka", "flink", "dbt", "data build tool", "data modeling", "data lake",
    "data lakehouse", "data mesh", "delta lake", "apache iceberg", "apache hudi",
    # orchestration
    "airflow", "luigi", "prefect", "dagster",
    # warehouses
    "snowflake", "bigquery", "redshift", "databricks",
    # databases
    "postgresql", "mysql", "mongodb", "redis", "elasticsearch", "opensearch", "neo4j",
    # cloud
    "aws", "gcp", "google cloud", "azure", "cloud computing",
    # infrastructure
    "docker", "kubernetes", "terraform", "helm", "serverless", "lambda", "cloud functions",
    # developer tools
    "git", "github", "gitlab", "linux", "rest api", "graphql", "microservices",
    # analytics
    "data analysis", "data analytics", "business intelligence", "product analytics",
    "growth analytics",
    # visualisation
    "tableau", "power bi", "looker", "matplotlib", "seaborn", "plotly", "d3.js", "grafana",
    # spreadsheets
    "excel",
    # responsible use
    "responsible ai", "ai governance", "model explainability", "fairness", "bias detection",
    "privacy", "gdpr", "feature store",
    # German
    "ki", "maschinelles lernen", "datenwissenschaft", "datenanalyse", "visualisierung",
)

SKILL_ALIASES = {
    "py": "python",
    "python3": "python",
    "ml": "machine learning",
    "machine-learning": "machine learning",
    "cicd": "ci/cd",
    "ci cd": "ci/cd",
    "amazon web services": "aws",
    "k8s": "kubernetes",
    "ms excel": "excel",
}

# --- staffing agencies: lower-case name parts (fixed values) ---------------------------------

AGENCY_NAMES = (
    "academic work", "careerplus", "adecco", "randstad", "manpower", "michael page", "hays",
    "rocken", "joker personal", "progress personal", "avalect", "hamilton services",
    "personal knobel", "ictjobs", "myscience", "amaris", "mantu", "trio personal", "art of work",
    "prime21", "integraal", "yellowshark", "jobtalent", "selected sa", "finders", "pks personal",
    "universal-job", "workmanagement", "endago", "engineering management selection", "page group",
    "fachkraft", "nemensis", "work selection",
)

# --- Swiss geography (fixed values) ----------------------------------------------------------

CANTON_CODES = (
    "ZH", "BE", "LU", "UR", "SZ", "OW", "NW", "GL", "ZG", "FR", "SO", "BS", "BL", "SH", "AR",
    "AI", "SG", "GR", "AG", "TG", "TI", "VD", "VS", "NE", "GE", "JU",
)

COMPANY_MARKERS = (
    "AG", "SA", "GmbH", "Sàrl", "Sagl", "Group", "Inc", "Corp", "Holding", "Bank", "Institut",
    "Hochschule", "Université", "Genossenschaft", "Versicherung", "Spital", "Foundation",
    "Consulting", "Engineering", "Technologies", "Systems", "Services", "Solutions", "Analytics",
    "Media", "Partners", "Association", "NCCR",
)

REGION_MARKERS = (
    "Deutschschweiz", "Innerschweiz", "Ostschweiz", "Mittelland", "Zentralschweiz", "Region ",
    "Raum ", "Liechtenstein",
)

CANTON_NAMES = {
    "zürich": "ZH", "zurich": "ZH", "bern": "BE", "berne": "BE", "luzern": "LU", "lucerne": "LU",
    "zug": "ZG", "aargau": "AG", "thurgau": "TG", "graubünden": "GR", "solothurn": "SO",
    "schaffhausen": "SH", "fribourg": "FR", "freiburg": "FR", "neuchâtel": "NE",
    "neuchatel": "NE", "genf": "GE", "geneva": "GE", "genève": "GE", "vaud": "VD",
    "wallis": "VS", "valais": "VS", "ticino": "TI", "tessin": "TI", "appenzell": "AR",
    "schwyz": "SZ", "glarus": "GL", "uri": "UR", "nidwalden": "NW", "obwalden": "OW",
    "jura": "JU", "basel-stadt": "BS", "basel-land": "BL", "baselland": "BL",
}

CITY_CANTON = {
    "Zürich": "ZH", "Zurich": "ZH", "Winterthur": "ZH", "Schlieren": "ZH", "Männedorf": "ZH",
    "Dübendorf": "ZH", "Wallisellen": "ZH", "Kloten": "ZH", "Opfikon": "ZH", "Uster": "ZH",
    "Glattpark": "ZH", "Volketswil": "ZH", "Dietikon": "ZH", "Thalwil": "ZH", "Stäfa": "ZH",
    "Rüti ZH": "ZH", "Wetzikon ZH": "ZH", "Buchs ZH": "ZH", "Seuzach": "ZH", "Fehraltorf": "ZH",
    "Zürcher Oberland": "ZH", "Zürich Oerlikon": "ZH", "Kanton Zürich": "ZH", "Rüschlikon": "ZH",
    "Dietlikon": "ZH",
    "Bern": "BE", "Berne": "BE", "Biel": "BE", "Thun": "BE", "Köniz": "BE", "Burgdorf": "BE",
    "Ostermundigen": "BE", "Kehrsatz": "BE", "Affoltern im Emmental": "BE", "Niederönz": "BE",
    "Basel": "BS", "Basel-Stadt": "BS",
    "Allschwil": "BL", "Liestal": "BL", "Münchenstein": "BL", "Bubendorf": "BL",
    "Lausanne": "VD", "Montreux": "VD", "Gland": "VD", "Nyon": "VD", "Yverdon-les-Bains": "VD",
    "Yverdon": "VD", "Morges": "VD", "Bussigny-près-Lausanne": "VD", "Epalinges": "VD",
    "Crissier": "VD", "Renens VD": "VD", "Vevey": "VD", "Corsier-sur-Vevey": "VD",
    "Geneva": "GE", "Genève": "GE", "Geneve": "GE", "Plan-les-Ouates": "GE", "Meyrin": "GE",
    "Carouge": "GE", "Petit-Lancy": "GE", "Grand-Lancy": "GE",
    "Sion": "VS", "Martigny": "VS", "Wallis": "VS", "Sierre": "VS", "Monthey": "VS",
    "Chalais": "VS",
    "Fribourg": "FR", "Givisiez": "FR", "Freiburg": "FR", "Bulle": "FR", "Morat": "FR",
    "St. Gallen": "SG", "Saint Gallen": "SG", "Uzwil": "SG", "Gossau": "SG", "Wil": "SG",
    "Ebnat-Kappel": "SG", "Haag": "SG",
    "Lugano": "TI", "Bellinzona": "TI", "Losone": "TI",
    "Lucerne": "LU", "Luzern": "LU", "Sursee": "LU", "Kriens": "LU",
    "Aarau": "AG", "Baden": "AG", "Lenzburg": "AG", "Brugg": "AG", "Zofingen": "AG",
    "Dättwil": "AG", "Ehrendingen": "AG", "Aargau": "AG",
    "Zug": "ZG", "Rotkreuz": "ZG", "Baar": "ZG", "Cham": "ZG",
    "Solothurn": "SO", "Olten": "SO",
    "Neuchâtel": "NE", "Neuchatel": "NE", "La Chaux-de-Fonds": "NE", "Le Crêt-du-Locle": "NE",
    "Le Landeron": "NE",
    "Chur": "GR",
    "Frauenfeld": "TG", "Romanshorn": "TG", "Egnach": "TG", "Sulgen": "TG", "Münchwilen": "TG",
    "Kanton Thurgau": "TG",
    "Schaffhausen": "SH",
    "Schwyz": "SZ", "Lachen SZ": "SZ", "Pfäffikon": "SZ", "Unteriberg": "SZ",
    "Feusisberg": "SZ", "Wollerau": "SZ",
}

COMPANY_CANTON = {
    "CERN European Organization for Nuclear Research": "GE",
    "Banque Pictet & Cie SA": "GE",
    "Bank Julius Bär & Co. AG": "GE",
    "Banque Lombard Odier & Cie SA": "GE",
    "Vitol": "GE",
    "Kudelski S.A.": "GE",
    "H55 SA": "GE",
    "Energy Vault SA": "GE",
    "HYDRO Exploitation SA": "GE",
    "Kepler Cheuvreux (Suisse) SA": "GE",
    "SIB Institut Suisse de Bioinformatique": "GE",
    "Scandit AG": "ZH",
    "Hitachi Energy AG": "ZH",
    "On AG": "ZH",
    "SonarSource SA": "ZH",
    "Nexthink SA": "ZH",
    "GetYourGuide AG": "ZH",
    "SkyCell AG": "ZH",
    "ti&m AG": "ZH",
    "Avaloq Group AG": "ZH",
    "lastminute.com group": "ZH",
    "Daedalean AG": "ZH",
    "SIX Group AG": "ZH",
    "Open Systems AG": "ZH",
    "Exeon Analytics AG": "ZH",
    "AXA Versicherungen AG": "ZH",
    "ZHAW Zürcher Hochschule für Angewandte Wissenschaften": "ZH",
    "Zühlke Engineering AG": "ZH",
    "Swiss International Air Lines AG": "ZH",
    "Edelweiss Air AG": "ZH",
    "SR Technics Switzerland AG": "ZH",
    "swissQuant Group AG": "ZH",
    "comparis.ch AG": "ZH",
    "SMG Swiss Marketplace Group": "ZH",
    "AutoForm Development GmbH": "ZH",
    "Vontobel Beteiligungen AG": "ZH",
    "Sonova AG": "ZH",
    "Wingtra AG": "ZH",
    "Frontify AG": "ZH",
    "EAWAG Dübendorf, Eidg. Anstalt für Wasser-, Abwasserreinigung & Gewässerschutz": "ZH",
    "D ONE Value Creation AG": "ZH",
    "adesso Schweiz AG": "ZH",
    "myScience": "ZH",
    "ZüriPharm AG": "ZH",
    "Maag Pump Systems AG": "ZH",
    "isolutions AG": "ZH",
    "PPCmetrics AG": "ZH",
    "Supercomputing Systems AG": "ZH",
    "Zürcher Hochschule der Künste": "ZH",
    "ServiceNow": "ZH",
    "Deloitte": "ZH",
    "NielsenIQ": "ZH",
    "Octapharma AG": "ZH",
    "Ernst & Young AG": "ZH",
    "Swiss Life AG": "ZH",
    "Sika AG": "ZH",
    "ISS Schweiz": "ZH",
    "Impact Hub Zürich AG": "ZH",
    "Novartis AG": "BS",
    "Universitätsspital Basel": "BS",
    "Basler Kantonalbank": "BS",
    "Bank Cler AG": "BS",
    "Syngenta Group": "BS",
    "Huntsman Advanced Materials (Switzerland) GmbH": "BL",
    "Hamilton Services AG": "BE",
    "Energie Wasser Bern": "BE",
    "Implenia Schweiz AG": "BE",
    "Ramboll AG": "BE",
    "CSL Behring AG": "BE",
    "Université de Lausanne": "VD",
    "UCB-Pharma SA": "VD",
    "Magellan Partners": "VD",
    "Bobst Mex SA": "VD",
    "salesforce.com Sàrl": "VD",
    "Amaris Consulting Sàrl": "VD",
    "Talan SA": "VD",
    "VF International Sagl": "VD",
    "selected sa": "VD",
    "MANTA GROUP SA": "VD",
    "Baloise Versicherung AG": "AG",
    "Mettler-Toledo GmbH": "AG",
    "Thermo Fisher Scientific (Schweiz) AG": "AG",
    "GF Machining Solutions Management SA": "AG",
    "RUAG AG": "AG",
    "Paul Scherrer Institut (PSI)": "AG",
    "Stadler Rail Group": "SG",
    "St.Galler Stadtwerke": "SG",
    "Büchi Labortechnik AG": "SG",
    "Hochschule Luzern (HSLU)": "LU",
    "SCOR Services Switzerland AG": "SO",
    "Agie Charmilles SA, Losone": "TI",
    "Officine Ghidoni SA": "TI",
    "Comfone AG": "NE",
    "Etat du canton de Fribourg": "FR",
    "LGT Bank AG": "GR",
    "Bank Frick AG": "GR",
    "Prismalife AG": "GR",
    "Peoplefone AG": "GR",
}

COMPANY_CITY = {
    "Scandit AG": "Zürich",
    "Hitachi Energy AG": "Zürich",
    "On AG": "Zürich",
    "SonarSource SA": "Zürich",
    "Nexthink SA": "Zürich",
    "GetYourGuide AG": "Zürich",
    "SkyCell AG": "Zürich",
    "ti&m AG": "Zürich",
    "Avaloq Group AG": "Zürich",
    "lastminute.com group": "Zürich",
    "Daedalean AG": "Zürich",
    "SIX Group AG": "Zürich",
    "Open Systems AG": "Zürich",
    "Exeon Analytics AG": "Zürich",
    "AXA Versicherungen AG": "Zürich",
    "Zühlke Engineering AG": "Zürich",
    "Swiss International Air Lines AG": "Zürich",
    "swissQuant Group AG": "Zürich",
    "comparis.ch AG": "Zürich",
    "SMG Swiss Marketplace Group": "Zürich",
    "AutoForm Development GmbH": "Zürich",
    "Vontobel Beteiligungen AG": "Zürich",
    "Sonova AG": "Zürich",
    "D ONE Value Creation AG": "Zürich",
    "adesso Schweiz AG": "Zürich",
    "myScience": "Zürich",
    "ServiceNow": "Zürich",
    "Deloitte": "Zürich",
    "NielsenIQ": "Zürich",
    "Octapharma AG": "Zürich",
    "Ernst & Young AG": "Zürich",
    "Swiss Life AG": "Zürich",
    "Sika AG": "Zürich",
    "ISS Schweiz": "Zürich",
    "PPCmetrics AG": "Zürich",
    "Supercomputing Systems AG": "Zürich",
    "Wingtra AG": "Zürich",
    "Frontify AG": "Zürich",
    "isolutions AG": "Zürich",
    "Impact Hub Zürich AG": "Zürich",
    "SCOR Services Switzerland AG": "Zürich",
    "Jabil Switzerland Manufacturing GmbH": "Zürich",
    "SR Technics Switzerland AG": "Zürich",
    "Edelweiss Air AG": "Zürich",
    "Zürcher Hochschule der Künste": "Zürich",
    "ZüriPharm AG": "Zürich",
    "Maag Pump Systems AG": "Zürich",
    "FIS (Switzerland) SA, Zweigniederlassung Zürich": "Zürich",
    "Medartis AG": "Zürich",
    "ZHAW Zürcher Hochschule für Angewandte Wissenschaften": "Winterthur",
    "Winterthur Gas & Diesel AG": "Winterthur",
    "EAWAG Dübendorf, Eidg. Anstalt für Wasser-, Abwasserreinigung & Gewässerschutz": "Dübendorf",
    "CERN European Organization for Nuclear Research": "Meyrin",
    "Banque Pictet & Cie SA": "Genève",
    "Bank Julius Bär & Co. AG": "Genève",
    "Banque Lombard Odier & Cie SA": "Genève",
    "Vitol": "Genève",
    "Kudelski S.A.": "Genève",
    "H55 SA": "Genève",
    "Energy Vault SA": "Genève",
    "HYDRO Exploitation SA": "Genève",
    "Kepler Cheuvreux (Suisse) SA": "Genève",
    "SIB Institut Suisse de Bioinformatique": "Genève",
    "Novartis AG": "Basel",
    "Universitätsspital Basel": "Basel",
    "Basler Kantonalbank": "Basel",
    "Bank Cler AG": "Basel",
    "Syngenta Group": "Basel",
    "Manor AG": "Basel",
    "Huntsman Advanced Materials (Switzerland) GmbH": "Münchenstein",
    "Hamilton Services AG": "Bern",
    "Energie Wasser Bern": "Bern",
    "Implenia Schweiz AG": "Bern",
    "Ramboll AG": "Bern",
    "CSL Behring AG": "Bern",
    "Comfone AG": "Bern",
    "RUAG AG": "Bern",
    "Mobility Genossenschaft": "Bern",
    "Université de Lausanne": "Lausanne",
    "UCB-Pharma SA": "Lausanne",
    "Magellan Partners": "Lausanne",
    "salesforce.com Sàrl": "Lausanne",
    "Amaris Consulting Sàrl": "Lausanne",
    "Talan SA": "Lausanne",
    "selected sa": "Lausanne",
    "MANTA GROUP SA": "Lausanne",
    "VAUDOISE ASSURANCES HOLDING SA": "Lausanne",
    "Bobst Mex SA": "Mex",
    "VF International Sagl": "Stabio",
    "Baloise Versicherung AG": "Liestal",
    "Mettler-Toledo GmbH": "Greifensee",
    "Thermo Fisher Scientific (Schweiz) AG": "Reinach",
    "GF Machining Solutions Management SA": "Biel/Bienne",
    "Paul Scherrer Institut (PSI)": "Villigen",
    "Peoplefone AG": "Aarau",
    "finnova AG Bankware": "Lenzburg",
    "Stadler Rail Group": "Bussnang",
    "St.Galler Stadtwerke": "St. Gallen",
    "Büchi Labortechnik AG": "Flawil",
    "CH Media Holding AG": "St. Gallen",
    "Hochschule Luzern (HSLU)": "Luzern",
    "Agie Charmilles SA, Losone": "Losone",
    "Officine Ghidoni SA": "Bellinzona",
    "Etat du canton de Fribourg": "Fribourg",
    "LGT Bank AG": "Vaduz",
    "Bank Frick AG": "Balzers",
}

CANTON_REGION = {
    "ZH": "Zurich",
    "BE": "Espace Mittelland",
    "LU": "Central Switzerland",
    "UR": "Central Switzerland",
    "SZ": "Central Switzerland",
    "OW": "Central Switzerland",
    "NW": "Central Switzerland",
    "GL": "Eastern Switzerland",
    "ZG": "Central Switzerland",
    "FR": "Espace Mittelland",
    "SO": "Espace Mittelland",
    "BS": "Northwestern Switzerland",
    "BL": "Northwestern Switzerland",
    "SH": "Eastern Switzerland",
    "AR": "Eastern Switzerland",
    "AI": "Eastern Switzerland",
    "SG": "Eastern Switzerland",
    "GR": "Eastern Switzerland",
    "AG": "Northwestern Switzerland",
    "TG": "Eastern Switzerland",
    "TI": "Ticino",
    "VD": "Lake Geneva Region",
    "VS": "Lake Geneva Region",
    "NE": "Espace Mittelland",
    "GE": "Lake Geneva Region",
    "JU": "Espace Mittelland",
}

# --- labels of the official statistics (fixed values) ----------------------------------------

MACRO_REGION_LABELS = {
    "Region lémanique": "Lake Geneva Region",
    "Espace Mittelland": "Espace Mittelland",
    "Nordwestschweiz": "Northwestern Switzerland",
    "Zürich": "Zurich",
    "Ostschweiz": "Eastern Switzerland",
    "Zentralschweiz": "Central Switzerland",
    "Ticino": "Ticino",
}

MACRO_INDUSTRY_LABELS = {
    "10-33 Manufactury": "10-33 Manufacturing",
    "41-43 Construction": "41-43 Construction",
    "49-53 Transport and stockage": "49-53 Transport and storage",
    "55-56 Hotels and gastronomy": "55-56 Hospitality",
    "58-63 IT and communications": "58-63 ICT",
    "62-63 IT and other information services": "62-63 IT services",
    "64-66 Finance and assurance": "64-66 Finance and Insurance",
    "68-75 Real estate and scientific service activities":
        "68-75 Real estate & professional services",
    "77+79-82 Administrative and support service activities (without 78)":
        "77+79-82 Administrative services",
    "84 Public administration": "84 Public administration",
    "85 Education": "85 Education",
    "86-88 Health and social work activities": "86-88 Health and social work",
    "90-96 Arts and amusement": "90-96 Arts and amusement",
}

# --- extraction word patterns (fixed values) -------------------------------------------------
# Alternations are tried as whole words on lower-cased text, in this order.

SENIORITY_TITLE_PATTERNS = (
    ("intern", "intern|internship|stage|stagiaire|praktikant|werkstudent|trainee"),
    ("mid", "postdoc|postdoctoral"),
    ("junior", r"junior|jr\.?"),
    ("lead", "lead|principal|head of|chapter lead|teamleiter|manager"),
    ("senior", r"senior|sr\.?"),
    ("mid", "mid[- ]level|medior"),
)

SENIORITY_TEXT_PATTERNS = (
    ("intern", "internship|praktikum|werkstudent|stipend"),
    ("mid", "postdoc|postdoctoral"),
    ("junior", r"entry[- ]level|berufseinsteiger|first[^\n]?job"),
    ("lead", "you will lead|leading a team|manage a team|verantwortlich für das team"),
)

EXPERIENCE_YEAR_WORDS = r"years?|ans?|jahre?|anni"
EXPERIENCE_WORDS = "experience|expérience|erfahrung|esperienza"
EXPERIENCE_RANGE_WORDS = "to|-|bis|à"
JUNIOR_MAX_YEARS = 2
MID_MAX_YEARS = 5

SALARY_CURRENCY = "chf"
SALARY_RANGE_WORDS = "to|bis|-|–"
SALARY_MONTH_WORDS = ("per", "month")
SALARY_BOUNDS = (10_000, 500_000)
TYPOGRAPHIC_APOSTROPHES = "’‘′"
