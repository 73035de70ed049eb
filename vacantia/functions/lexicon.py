"""Skill lexicon and taxonomy."""

from __future__ import annotations

import re

# ---------------------------------------------------------------- fixed values
# skill -> alias patterns, tried in order; matched between word boundaries, any case.
SKILLS = {
    "python": ["python", "py3", "python3"],
    "sql": ["sql", "tsql", "plsql", "mysql", "postgresql", "sqlite"],
    "java": ["java(?!script)", r"\bjava\b"],
    "javascript": ["javascript", "js", "node.js", "node", "typescript", "ts"],
    "r": [r"\br\b", "r programming", "r language"],
    "scala": ["scala"],
    "golang": ["go", "golang"],
    "rust": ["rust"],
    "cpp": [r"c\+\+", "c plus plus"],
    "csharp": ["c#", "csharp", "dotnet"],
    "php": ["php"],
    "pandas": ["pandas", "dataframe"],
    "numpy": ["numpy", "numerical python"],
    "scikit-learn": ["scikit-learn", "sklearn"],
    "spark": ["spark", "pyspark", "apache spark"],
    "hadoop": ["hadoop"],
    "hive": ["hive", "apache hive"],
    "pig": ["apache pig", "pig"],
    "kafka": ["kafka", "apache kafka"],
    "airflow": ["airflow", "apache airflow", "dag"],
    "luigi": ["luigi"],
    "dbt": ["dbt", "data build tool"],
    "talend": ["talend"],
    "informatica": ["informatica"],
    "ssis": ["ssis", "sql server integration"],
    "etl": ["etl", "extract transform load"],
    "elt": ["elt", "extract load transform"],
    "postgresql": ["postgresql", "postgres", "psql"],
    "mysql": ["mysql"],
    "mongodb": ["mongodb", "mongo", "nosql"],
    "cassandra": ["cassandra", "apache cassandra"],
    "dynamodb": ["dynamodb"],
    "redis": ["redis"],
    "elasticsearch": ["elasticsearch", "elastic search"],
    "snowflake": ["snowflake"],
    "redshift": ["redshift", "amazon redshift"],
    "bigquery": ["bigquery", "big query"],
    "teradata": ["teradata"],
    "oracle": ["oracle database", "oracle"],
    "sqlserver": ["sql server", "mssql"],
    "tensorflow": ["tensorflow", "tf"],
    "pytorch": ["pytorch", "torch"],
    "keras": ["keras"],
    "xgboost": ["xgboost"],
    "lightgbm": ["lightgbm", "light gbm"],
    "catboost": ["catboost"],
    "mlflow": ["mlflow"],
    "machine_learning": ["machine learning", r"ml\b", r"machine\s+learning"],
    "deep_learning": ["deep learning", "neural network"],
    "nlp": ["nlp", "natural language processing", "text mining"],
    "computer_vision": ["computer vision", r"cv\b", "image processing"],
    "aws": ["aws", "amazon web services", "ec2", "s3", "lambda", "rds"],
    "gcp": ["gcp", "google cloud", "bigquery", "dataflow"],
    "azure": ["azure", "microsoft azure", "synapse", "cosmosdb"],
    "kubernetes": ["kubernetes", "k8s", "container"],
    "docker": ["docker"],
    "tableau": ["tableau"],
    "powerbi": ["power bi", "powerbi", "power-bi"],
    "qlik": ["qlik", "qlikview", "qliktools"],
    "looker": ["looker", "google looker"],
    "metabase": ["metabase"],
    "grafana": ["grafana"],
    "excel": ["excel", "vba"],
    "power_pivot": ["power pivot", "pivot table"],
    "git": ["git(?!hub)", r"\bgit\b", "github", "gitlab"],
    "jenkins": ["jenkins"],
    "gitlab": ["gitlab"],
    "github": ["github"],
    "terraform": ["terraform"],
    "ansible": ["ansible"],
    "ci_cd": ["ci/cd", "continuous integration", "continuous delivery"],
    "jupyter": ["jupyter", "jupyter notebook", "ipython"],
    "sagemaker": ["sagemaker"],
    "dataiku": ["dataiku"],
    "knime": ["knime"],
    "spss": ["spss", "ibm spss"],
    "sas": ["sas"],
    "apache": ["apache"],
}

# category -> skills; a skill without a category is "Other".
TAXONOMY = {
    "Programming Languages": [
        "python", "sql", "java", "javascript", "r", "scala", "golang", "rust", "cpp", "csharp",
        "php",
    ],
    "Data Engineering": [
        "spark", "hadoop", "hive", "kafka", "airflow", "luigi", "dbt", "etl", "elt", "talend",
        "informatica", "ssis",
    ],
    "Databases": [
        "postgresql", "mysql", "mongodb", "cassandra", "dynamodb", "redis", "elasticsearch",
        "snowflake", "redshift", "bigquery", "oracle", "sqlserver",
    ],
    "Data Analysis": ["pandas", "numpy", "scikit-learn", "excel", "power_pivot"],
    "Machine Learning": [
        "tensorflow", "pytorch", "keras", "xgboost", "lightgbm", "catboost", "mlflow",
        "machine_learning", "deep_learning",
    ],
    "NLP & AI": ["nlp", "computer_vision"],
    "Cloud Platforms": ["aws", "gcp", "azure", "kubernetes", "docker", "sagemaker"],
    "BI & Visualization": ["tableau", "powerbi", "qlik", "looker", "metabase", "grafana"],
    "DevOps & Tools": [
        "git", "jenkins", "ci_cd", "terraform", "ansible", "jupyter", "dataiku", "knime", "spss",
        "sas",
    ],
}
# ------------------------------------------------------------------------------

# What may follow the leading word of an alias so that the word is a whole token of any
# text the alias matches: the end, a boundary, a lookahead, or a character outside \w.
_WHOLE = re.compile(r"(?:\\b)?(\w+)(?:$|\\b|\(\?!|\\s\+|\\[+.#/\-]|[ \-/#])")


def head_token(alias: str) -> str | None:
    """Leading whole word of an alias; None if the alias need not start with one token."""
    found = _WHOLE.match(alias)
    return found.group(1).lower() if found else None


_SEPARATOR = re.compile(r"\\s\+|[ \-/#]")


def whole_tokens(alias: str, right_boundary: bool = True) -> list[str]:
    """Words that every text with the alias has as whole tokens; at least the leading one where there is one.

    Without a boundary behind the alias its last word may go on in the text and is left out.
    """
    head = head_token(alias)
    body = re.sub(r"^(?:\\b)+|(?:\\b)+$", "", alias)
    words = _SEPARATOR.split(body)
    if head is None or not all(re.fullmatch(r"\w+", w) for w in words):
        return [head] if head else []
    closed = right_boundary or alias.endswith(r"\b")
    return [w.lower() for w in (words if closed else words[:-1])] or [head]

