"""Values that have to be exactly these for results to be right.

Everything here is data: word lists, column contracts and thresholds. All are
defaults; the operators take their taxonomy, features and limits as arguments.
"""

# Skill taxonomy, category -> canonical spellings, in order.
SKILL_TAXONOMY = {
    "Programming Languages": [
        "Python", "Java", "C++", "C", "JavaScript", "TypeScript", "Go", "Rust",
        "SQL", "R", "Scala", "Kotlin", "Swift", "PHP", "Ruby", "MATLAB",
    ],
    "Web & Frameworks": [
        "React", "Angular", "Vue.js", "Node.js", "Django", "Flask", "FastAPI",
        "Spring Boot", "Express.js", "HTML", "CSS", "REST API", "GraphQL",
    ],
    "Data & ML": [
        "Machine Learning", "Deep Learning", "NLP", "Computer Vision",
        "TensorFlow", "PyTorch", "scikit-learn", "Keras", "Pandas", "NumPy",
        "Data Analysis", "Data Visualization", "Statistics", "XGBoost",
        "Feature Engineering", "MLOps",
    ],
    "Big Data & Cloud": [
        "Apache Spark", "Hadoop", "Kafka", "Airflow", "Hive", "AWS", "Azure",
        "GCP", "Docker", "Kubernetes", "Elasticsearch", "Delta Lake",
        "Data Warehousing", "ETL", "Snowflake",
    ],
    "Databases": [
        "MySQL", "PostgreSQL", "MongoDB", "Redis", "Cassandra", "Oracle",
        "SQLite", "DynamoDB",
    ],
    "Tools & Practices": [
        "Git", "Linux", "CI/CD", "Jenkins", "Agile", "Scrum", "JIRA",
        "Unit Testing", "System Design", "Microservices",
    ],
    "Soft Skills": [
        "Communication", "Teamwork", "Leadership", "Problem Solving",
        "Time Management", "Critical Thinking",
    ],
    "Certifications": [
        "AWS Certified Solutions Architect", "Google Data Analytics",
        "PMP", "CCNA", "Salesforce Certified", "Azure Fundamentals",
    ],
}

# Spellings that only count in exactly this case.
CASE_SENSITIVE_SKILLS = ("Go", "C", "R")

# Fixed value: category of a skill the taxonomy does not know.
OTHER_CATEGORY = "Other"

# Skills imputed for the external student file.
SPECIALISATION_SKILLS = {
    "Mkt&HR": ["Communication", "Leadership", "Teamwork", "Critical Thinking",
               "Time Management", "Problem Solving"],
    "Mkt&Fin": ["Communication", "SQL", "Data Analysis", "Statistics",
                "Critical Thinking", "Problem Solving"],
}
DEGREE_SKILLS = {
    "Sci&Tech": ["Python", "Java", "SQL", "Machine Learning", "Data Analysis", "Git"],
    "Comm&Mgmt": ["Communication", "Leadership", "Teamwork", "Time Management"],
    "Others": ["Communication", "Problem Solving", "Teamwork"],
}

# Column contracts of uploaded files.
POSTING_REQUIRED = ("title", "company", "description")
STUDENT_REQUIRED = ("cgpa", "projects_count", "certifications_count",
                    "internships_count", "skills")
STUDENT_NUMERIC = ("cgpa", "projects_count", "certifications_count",
                   "internships_count")

# Model features, in model order.
FEATURES = ("cgpa", "projects_count", "certifications_count",
            "internships_count", "skill_count", "market_alignment_score")

# Tiers from safest to most at risk, with their lower bounds.
TIER_BOUNDS = (("On track", 0.7), ("Needs a push", 0.4), ("At risk", None))
UNKNOWN_TIER = "Unknown"

# Fixed value: company shown in search results when a posting names none.
UNKNOWN_COMPANY = "Unknown company"

# Cell texts a CSV reader of tabular tools takes for "missing".
CSV_MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
               "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
               "NaN", "None", "n/a", "nan", "null")

# How much of each ranked gap list the reports use.
TOP_GAPS_STORED = 10
TOP_GAPS_SEARCHED = 6
TOP_GAPS_COHORT = 5
TOP_GAPS_LISTED = 3
TOP_GAPS_SIMULATED = 2

# Fields of a processed posting, in order.
PROCESSED_FIELDS = ("posting_id", "title", "company", "description", "extracted_skills",
                    "skill_categories")
