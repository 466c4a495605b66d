"""The terms, labels and weights that results depend on, in the notation of rules.py."""

# City, province and their terms, first match wins.
CITIES = [
    ("Cape Town", "Western Cape", ["cape_town", "cpt"]),
    ("Stellenbosch", "Western Cape", ["stellenbosch"]),
    ("Johannesburg", "Gauteng", ["johannesburg", "jhb", "sandton", "rosebank", "randburg", "midrand"]),
    ("Pretoria", "Gauteng", ["pretoria", "pta"]),
    ("Centurion", "Gauteng", ["centurion"]),
    ("Durban", "KwaZulu-Natal", ["durban", "dbn", "umhlanga"]),
    ("Gqeberha", "Eastern Cape", ["gqeberha", "port elizabeth"]),
    ("Bloemfontein", "Free State", ["bloemfontein"]),
]
HOME = "South Africa"
# Countries and their terms, first match wins.
COUNTRIES = [
    (HOME, ["south africa", "za"]),
    ("United Kingdom", ["united kingdom", "uk", "england", "scotland"]),
    ("United States", ["united states", "usa", "u.s.a"]),
    ("Portugal", ["portugal"]),
    ("Netherlands", ["netherlands"]),
    ("Germany", ["germany"]),
    ("Ireland", ["ireland"]),
    ("Canada", ["canada"]),
    ("Australia", ["australia"]),
    ("Singapore", ["singapore"]),
    ("Malaysia", ["malaysia"]),
    ("India", ["india"]),
    ("Nigeria", ["nigeria"]),
    ("Kenya", ["kenya"]),
    ("Spain", ["spain"]),
    ("France", ["france"]),
]
REMOTE_HOME = ["remote {within|in|from} south africa", "based in south africa", "south africa-based", "candidate(s) (must be ){located|based} in south africa"]
# Country codes of postings.
COUNTRY_CODES = {
    "ZA": "South Africa", "GB": "United Kingdom", "US": "United States", "CA": "Canada", "AU": "Australia", "DE": "Germany",
    "FR": "France", "IE": "Ireland", "IN": "India", "KE": "Kenya", "MY": "Malaysia", "NG": "Nigeria", "NL": "Netherlands",
    "PT": "Portugal", "SG": "Singapore", "ES": "Spain",
}
# Workplace labels, first match wins; spellings of an explicit label.
WORKPLACES = [("hybrid", ["hybrid"]), ("remote", ["remote", "work from home", "fully distributed"]), ("on_site", ["on~site", "office-based", "in-office"])]
WORKPLACE_SPELLINGS = {"hybrid": "hybrid", "remote": "remote", "on-site": "on_site", "on site": "on_site", "onsite": "on_site"}
# Role levels by title, source level and description, first match wins.
SENIOR_TITLE = ["senior", "staff", "principal", "lead", "manager", "director", "head of", "architect", "vice president", "vp", "chief"]
EARLY_TITLE = [
    ("internship", ["intern(ship)", "vacation work", "learnership", "apprentice(ship)"]),
    ("graduate", ["graduate", "new grad", "grad programme", "grad program"]),
    ("junior", ["junior", "entry-level", "associate {software|data|qa|test|cloud|devops|security|business intelligence}", "{software|data|qa|test|cloud|devops|security} engineer i", "{software|web|backend|front~end|full~stack} developer i"]),
]
SOURCE_LEVEL = [("senior", SENIOR_TITLE), ("internship", ["intern(ship)"]), ("graduate", ["graduate", "new grad"]), ("junior", ["junior", "entry-level", "associate"])]
_YEARS = "year(s)( of (professional )experience)"
DESCRIPTION_LEVEL = [
    ("internship", ["this internship", "internship programme", "internship program"]),
    ("graduate", ["graduate programme", "graduate program", "new graduate", "recent graduate", "fresh graduate"]),
    ("junior", [
        "entry-level( {role|position|opportunity|candidate})", "early-career( {role|position|opportunity|candidate})",
        "0_{=|–|—|to}_{1|2} " + _YEARS, "1_{=|–|—|to}_2 " + _YEARS, "up to 2 " + _YEARS, "less than 2 " + _YEARS,
        "({minimum of |at least })1 year of (professional )experience", "no {prior |professional }({prior |professional })experience (is ){required|necessary}",
        "no experience (is ){required|necessary}", "no prior (work )experience",
    ]),
]
# Technology roles by title; where the title is a general early-career one, by department and description.
TECH_TITLE = [
    ("software", ["software", "application development"]),
    ("developer", ["developer", "front~end", "back~end", "full~stack", "web development", "mobile", "android engineer", "ios engineer"]),
    ("data", ["data {analyst|analytics|engineer|engineering|scientist|science|platform|warehouse|lead}", "analytic(s)", "database administrator"]),
    ("ai_ml", ["machine learning", "artificial intelligence", "ai engineer", "ml engineer", "genai", "applied ai"]),
    ("automation", ["automation", "rpa"]),
    ("security", ["cyber(security)", "information security", "security {analyst|engineer|operations}"]),
    ("cloud_devops", ["cloud", "devops", "site reliability", "sre", "platform engineer"]),
    ("quality_engineering", ["quality assurance", "qa", "test {engineer|automation|analyst}"]),
    ("business_intelligence", ["business intelligence", "bi {analyst|developer|engineer}"]),
    ("systems", ["system(s) {analyst|engineer}", "{integration|implementation|solution|solutions|support} engineer", "technical service(s) engineer", "it {analyst|support|engineer|technician|auditor}", "information technology", "blockchain"]),
    ("business_analysis", ["business analyst"]),
    ("product", ["product manager", "technical product"]),
]
TECH_VETO = ["data {capturer|capture|clerk|privacy|protection}", "software sales", "technical recruit{er|ment}"]
GENERIC_EARLY = ["{graduate|intern(ship)|junior|entry-level|learnership|apprentice(ship)}"]
TECH_DESCRIPTION = [
    ("software_engineering", ["software {engineering|development}"]),
    ("programming", ["programming", "coding"]),
    ("data", ["data {analytics|engineering|science}"]),
    ("cloud_devops", ["cloud {engineering|platform|infrastructure}", "devops"]),
    ("security", ["cybersecurity", "information security"]),
]
# Scored evidence (weight, level, terms) by where it stands.
SCORE_TITLE = [
    (15, "internship", ["intern(ship)", "vacation work", "learnership", "apprentice(ship)"]),
    (15, "graduate", ["graduate", "new grad", "grad(uate) programme", "grad(uate) program"]),
    (10, "junior", ["junior", "entry-level", "trainee"]),
    (6, "junior", ["associate"]),
    (6, "junior", ["{engineer|developer|analyst} i", "{engineer|developer|analyst} 1"]),
    (-2, "mid_level", ["{engineer|developer|analyst} ii", "{engineer|developer|analyst} 2"]),
    (-20, "senior", ["senior"]), (-24, "senior", ["staff"]), (-28, "senior", ["principal"]), (-24, "senior", ["lead"]),
    (-22, "senior", ["manager"]), (-28, "senior", ["director"]), (-28, "senior", ["head of"]), (-22, "senior", ["architect"]),
    (-30, "senior", ["vice president", "vp", "chief"]),
]
SCORE_SOURCE = [
    (15, "internship", ["intern(ship)"]),
    (15, "graduate", ["graduate", "new grad"]),
    (10, "junior", ["junior", "entry-level"]),
    (-3, "mid_level", ["mid(dle)-level", "intermediate"]),
    (-20, "senior", ["senior", "lead", "principal", "manager"]),
]
SCORE_DESCRIPTION = [
    (7, "junior", ["no {prior |professional }({prior |professional })experience (is ){required|necessary}", "no experience (is ){required|necessary}", "no prior (work )experience"]),
    (12, "graduate", ["recent graduate", "fresh graduate", "new graduate"]),
    (8, "junior", ["early-career", "entry-level"]),
]
TALENT_POOL = ["talent pool", "talent community", "expression of interest", "future opportunit{y|ies}"]
EARLY_LEVELS = ["internship", "graduate", "junior"]
# Review buckets of roles without a level.
AUDIT_EARLY = ["associate", "entry-level", "graduate", "junior", "intern(ship)", "trainee", "learnership", "apprentice(ship)"]
AUDIT_MID = ["engineer ii", "developer ii", "analyst ii", "consultant", "specialist"]
AUDIT_SENIOR = ["engineer iii", "developer iii", "analyst iii", "architect", "principal", "staff", "lead", "manager", "director", "head of"]
# Patterns of years of experience (Java and RE2).
YEARS_RANGE = r"\b(\d+)\s*(?:-|–|—|to)\s*(\d+)\s*(?:years?|yrs?)(?:\s*(?:of\s+)?(?:relevant\s+|professional\s+|work\s+)?experience)?\b"
YEARS_SINGLE = r"\b(?:(?:at\s+least|minimum(?:\s+of)?|min\.?)\s+)?(\d+)\s*(?:\+|plus)?\s*(?:years?|yrs?)(?:['’]?\s*(?:of\s+)?(?:relevant\s+|professional\s+|work\s+)?experience)?\b"
AUDIT_YEARS_RANGE = r"\b(\d+)\s*(?:-|–|—|to)\s*(\d+)\s+years?(?:\s+of\s+experience)?\b"
AUDIT_YEARS_SINGLE = [r"\b(?:at\s+least|minimum(?:\s+of)?|min\.?)\s+(\d+)\s+years?\b", r"\b(\d+)\s*\+\s*years?(?:\s+of\s+experience)?\b", r"\b(\d+)\s+years?\s+of\s+(?:relevant\s+|professional\s+|work\s+)?experience\b"]
# Labels that stand for nothing.
UNKNOWN = ["", "unknown", "unspecified", "ambiguous", "none"]

# Technologies with category and terms.
SKILLS = [
    ("Python", "programming_language", ["!.!python"]), ("Java", "programming_language", ["!.!java"]),
    ("JavaScript", "programming_language", ["javascript", "java_script"]), ("TypeScript", "programming_language", ["typescript", "type_script"]),
    ("C#", "programming_language", ["!!c_#", "csharp"]), ("C++", "programming_language", ["!!c_++"]), ("C", "programming_language", ["!+#!c"]),
    ("Go", "programming_language", ["golang", "go programming"]), ("Kotlin", "programming_language", ["kotlin"]), ("Swift", "programming_language", ["swift"]),
    ("PHP", "programming_language", ["php"]), ("Ruby", "programming_language", ["ruby"]), ("Scala", "programming_language", ["scala"]),
    ("R", "programming_language", ["r programming", "using r"]), ("SQL", "programming_language", ["sql", "structured query language"]),
    ("Bash", "programming_language", ["bash", "shell scripting"]),
    ("Spring Boot", "framework", ["spring boot"]), ("Spring", "framework", ["spring framework"]), (".NET", "framework", ["!!.net", "dotnet"]),
    ("ASP.NET", "framework", ["asp(.)net"]), ("Django", "framework", ["django"]), ("Flask", "framework", ["flask"]), ("FastAPI", "framework", ["fastapi", "fast api"]),
    ("Node.js", "framework", ["node(.)js"]), ("Express.js", "framework", ["express(.)js"]), ("React", "framework", ["react((.)js)"]),
    ("Angular", "framework", ["angular"]), ("Vue.js", "framework", ["vue((.)js)"]), ("Next.js", "framework", ["next(.)js"]), ("Laravel", "framework", ["laravel"]),
    ("Ruby on Rails", "framework", ["ruby on rails", "rails"]),
    ("Machine Learning", "data_ai", ["machine learning", "ml"]), ("Artificial Intelligence", "data_ai", ["artificial intelligence", "ai"]),
    ("Generative AI", "data_ai", ["generative ai", "genai", "gen ai"]), ("Large Language Models", "data_ai", ["large language model(s)", "llm(s)"]),
    ("Natural Language Processing", "data_ai", ["natural language processing", "nlp"]), ("Computer Vision", "data_ai", ["computer vision"]),
    ("Data Science", "data_ai", ["data science"]), ("Data Engineering", "data_ai", ["data engineering"]), ("ETL", "data_ai", ["etl", "extract{, | |,}transform{, | |,}load"]),
    ("Apache Spark", "data_ai", ["apache spark", "pyspark"]), ("Pandas", "data_ai", ["pandas"]), ("NumPy", "data_ai", ["numpy"]),
    ("scikit-learn", "data_ai", ["scikit-learn", "sklearn"]), ("TensorFlow", "data_ai", ["tensorflow"]), ("PyTorch", "data_ai", ["pytorch"]),
    ("Databricks", "data_ai", ["databricks"]), ("Snowflake", "data_ai", ["snowflake"]), ("dbt", "data_ai", ["!!dbt"]),
    ("AWS", "cloud", ["aws", "amazon web services"]), ("Azure", "cloud", ["azure"]), ("Google Cloud", "cloud", ["google cloud", "gcp"]), ("Cloud Computing", "cloud", ["cloud computing"]),
    ("PostgreSQL", "database", ["postgres(ql)"]), ("MySQL", "database", ["mysql"]), ("Microsoft SQL Server", "database", ["sql server", "mssql"]),
    ("Oracle Database", "database", ["oracle {database|db}"]), ("MongoDB", "database", ["mongodb"]), ("Redis", "database", ["redis"]), ("DynamoDB", "database", ["dynamodb"]),
    ("Elasticsearch", "database", ["elasticsearch"]), ("Cassandra", "database", ["cassandra"]), ("BigQuery", "database", ["bigquery", "big query"]),
    ("Git", "devops", ["git", "github", "gitlab"]), ("Docker", "devops", ["docker", "containerisation", "containerization"]), ("Kubernetes", "devops", ["kubernetes", "k8s"]),
    ("Terraform", "devops", ["terraform"]), ("Jenkins", "devops", ["jenkins"]), ("GitHub Actions", "devops", ["github actions"]), ("CI/CD", "devops", ["ci_/_cd", "continuous integration"]),
    ("Linux", "devops", ["linux"]),
    ("Microservices", "architecture", ["microservice(s)"]), ("REST APIs", "architecture", ["rest(ful) api(s)", "rest service(s)"]), ("GraphQL", "architecture", ["graphql"]),
    ("Kafka", "architecture", ["apache kafka", "kafka"]), ("RabbitMQ", "architecture", ["rabbitmq"]), ("Event-driven Architecture", "architecture", ["event-driven"]),
    ("Unit Testing", "testing", ["unit test(s)", "unit testing"]), ("Test Automation", "testing", ["test automation", "automated testing"]), ("Selenium", "testing", ["selenium"]),
    ("Cypress", "testing", ["cypress"]), ("Playwright", "testing", ["playwright"]), ("JUnit", "testing", ["junit"]), ("pytest", "testing", ["pytest"]), ("TDD", "testing", ["tdd", "test-driven development"]),
    ("Power BI", "analytics_tool", ["power_bi"]), ("Tableau", "analytics_tool", ["tableau"]), ("Looker", "analytics_tool", ["looker"]), ("Excel", "analytics_tool", ["microsoft excel", "excel"]),
    ("SAS", "analytics_tool", ["sas"]),
    ("SAP", "enterprise_platform", ["sap"]), ("Salesforce", "enterprise_platform", ["salesforce"]), ("ServiceNow", "enterprise_platform", ["servicenow"]),
]
# Soft skills, fields of study, phrases that require a degree.
SOFT_SKILLS = [
    ("Communication", ["communication skill(s)", "communicat{e|ion}"]), ("Collaboration", ["collaborat{e|ion|ive}", "teamwork"]),
    ("Problem Solving", ["problem-solving", "solve complex problem(s)"]), ("Analytical Thinking", ["analytical {skill|skills|thinking}"]),
    ("Attention to Detail", ["attention to detail"]), ("Adaptability", ["adaptab{le|ility}", "fast-paced"]), ("Leadership", ["leadership skill(s)"]),
    ("Stakeholder Management", ["stakeholder management"]), ("Time Management", ["time management"]), ("Curiosity", ["curiosity", "curiosious"]),
]
DEGREE_FIELDS = [
    ("Computer Science", ["computer science"]), ("Information Technology", ["information technology", "it degree"]), ("Software Engineering", ["software engineering"]),
    ("Information Systems", ["information system(s)"]), ("Data Science", ["data science"]), ("Statistics", ["statistic(s)", "statistical science"]),
    ("Mathematics", ["mathematic(s)", "mathematical science"]), ("Engineering", ["engineering degree", "degree in engineering"]),
    ("Business", ["business {degree|discipline|field}"]), ("Finance", ["finance {degree|discipline|field}"]),
]
DEGREE_REQUIRED = ["{bachelor(')(s)|bsc|b.sc(.)|btech|b.tech(.)|undergraduate} {degree|qualification}", "degree {in|required|essential}", "relevant (tertiary )qualification", "computer science degree"]
# Technology category and capability by category, and by technology where it differs.
CATEGORY_DIMENSIONS = {
    "programming_language": ("language", "Programming"), "framework": ("framework", "Application Development"), "data_ai": ("domain_or_data_tool", "Data and AI"),
    "cloud": ("cloud_platform", "Cloud"), "database": ("database_or_storage", "Data Storage"), "devops": ("devops_tool", "DevOps and Platform Engineering"),
    "architecture": ("architecture_or_messaging", "Backend and Architecture"), "testing": ("testing_tool_or_practice", "Quality Engineering"),
    "analytics_tool": ("analytics_or_bi_tool", "Analytics and BI"), "enterprise_platform": ("enterprise_platform", "Enterprise Technology"),
}
SKILL_DIMENSIONS = {
    "SQL": ("query_language", "Data Storage"), "Bash": ("scripting_language", "DevOps and Platform Engineering"),
    "Kotlin": ("language", "Mobile Development"), "Swift": ("language", "Mobile Development"),
    "React": ("frontend_framework", "Frontend Development"), "Angular": ("frontend_framework", "Frontend Development"),
    "Vue.js": ("frontend_framework", "Frontend Development"), "Next.js": ("frontend_framework", "Frontend Development"),
    "Machine Learning": ("domain", "AI and Machine Learning"), "Artificial Intelligence": ("domain", "AI and Machine Learning"),
    "Generative AI": ("domain", "AI and Machine Learning"), "Large Language Models": ("domain", "AI and Machine Learning"),
    "Natural Language Processing": ("domain", "AI and Machine Learning"), "Computer Vision": ("domain", "AI and Machine Learning"),
    "Data Science": ("domain", "Data and Analytics"), "Data Engineering": ("domain", "Data Engineering"), "ETL": ("data_practice", "Data Engineering"),
    "Apache Spark": ("data_processing_platform", "Data Engineering"), "Pandas": ("data_library", "Data and Analytics"), "NumPy": ("data_library", "Data and Analytics"),
    "scikit-learn": ("machine_learning_library", "AI and Machine Learning"), "TensorFlow": ("machine_learning_framework", "AI and Machine Learning"),
    "PyTorch": ("machine_learning_framework", "AI and Machine Learning"), "Databricks": ("data_platform", "Data Engineering"), "Snowflake": ("data_platform", "Data Engineering"),
    "dbt": ("data_transformation_tool", "Data Engineering"), "BigQuery": ("cloud_data_warehouse", "Data Engineering"), "Git": ("version_control", "Software Delivery"),
    "Kafka": ("messaging_platform", "Backend and Architecture"), "RabbitMQ": ("messaging_platform", "Backend and Architecture"),
    "REST APIs": ("backend_practice", "Backend and Architecture"), "Microservices": ("architecture_pattern", "Backend and Architecture"),
    "Event-driven Architecture": ("architecture_pattern", "Backend and Architecture"), "Linux": ("operating_system", "DevOps and Platform Engineering"),
    "CI/CD": ("delivery_practice", "Software Delivery"), "Cloud Computing": ("domain", "Cloud"),
}
