"""The researcher-metrics preset: 13 columns, spellings, limits and defaults."""

from __future__ import annotations

from tidemark.spec import CompareSpec, LightTransform, Metric, Rule

# Canonical column -> header in the source files, in load order.
COLUMN_MAPPING = {
    "name": "Name",
    "percent_docs_cited": "% Docs Cited",
    "web_of_science_documents": "Web of Science Documents",
    "rank": "Rank",
    "times_cited": "Times Cited",
    "affiliation": "Affiliation",
    "web_of_science_researcherid": "Web of Science ResearcherID",
    "category_normalised_citation_impact": "Category Normalized Citation Impact",
    "orcid": "ORCID",
    "highly_cited_papers": "Highly Cited Papers",
    "hot_papers": "Hot Papers",
    "esi_field": "ESI Field",
    "indicative_cross_field_score": "Indicative Cross-Field Score",
}

# Column types of a stored snapshot.
SNAPSHOT_SCHEMA = (
    "name STRING, percent_docs_cited DOUBLE, web_of_science_documents INT, rank INT, times_cited INT, "
    "affiliation STRING, web_of_science_researcherid STRING, category_normalised_citation_impact DOUBLE, "
    "orcid STRING, highly_cited_papers INT, hot_papers INT, esi_field STRING, "
    "indicative_cross_field_score DOUBLE"
)
FLAG_SCHEMA = "is_duplicate BOOLEAN, duplicate_profile STRING, duplicate_group_id STRING"
STORED_SCHEMA = f"{SNAPSHOT_SCHEMA}, {FLAG_SCHEMA}"

# Folded field name -> canonical field name.
CANONICAL_FIELDS = {
    "agricultural sciences": "Agricultural Sciences",
    "biology_biochemistry": "Biology Biochemistry",
    "chemistry": "Chemistry",
    "clinical medicine": "Clinical Medicine",
    "computer science": "Computer Science",
    "economics and business": "Economics and Business",
    "engineering": "Engineering",
    "environment_ecology": "Environment Ecology",
    "geosciences": "GeoSciences",
    "immunology": "Immunology",
    "materials science": "Materials Science",
    "microbiology": "Microbiology",
    "molecular biology and genetics": "Molecular Biology and Genetics",
    "neuroscience and behaviour": "Neuroscience and Behaviour",
    "pharmacology and toxicology": "Pharmacology and Toxicology",
    "physics": "Physics",
    "plant and animal science": "Plant and Animal Science",
    "psychiatry_psychology": "Psychiatry Psychology",
    "social sciences": "Social Sciences",
    "space science": "Space Science",
}

# What a missing value becomes under the default strategy.
NULL_DEFAULTS = {
    "percent_docs_cited": 0.0,
    "web_of_science_documents": 0,
    "rank": 0,
    "times_cited": 0,
    "affiliation": "Unknown",
    "web_of_science_researcherid": "",
    "category_normalised_citation_impact": 0.0,
    "orcid": "",
    "highly_cited_papers": 0,
    "hot_papers": 0,
    "indicative_cross_field_score": 0.0,
}

# Plausibility limits.
RULES = (
    Rule("times_cited", min_value=50, max_value=100000, required=True),
    Rule("highly_cited_papers", min_value=0, max_value=200, required=True),
    Rule("hot_papers", min_value=0, max_value=100, required=True),
    Rule("indicative_cross_field_score", min_value=0, max_value=10, required=True),
    Rule("percent_docs_cited", min_value=0, max_value=100),
    Rule("name", min_length=2, required=True),
    Rule("esi_field", min_length=2, required=True),
)

# Upper limits above which a value looks wrong.
# Limits, sheets, periods and columns of the researcher data.
HIGH_VALUES = {
    "times_cited": 500000,
    "highly_cited_papers": 500,
    "hot_papers": 200,
    "indicative_cross_field_score": 20,
}

SHEETS = ("Highly Cited only", "Incites Researchers")
PERIODS = ("feb", "july")
CRITICAL = (
    "name",
    "times_cited",
    "highly_cited_papers",
    "hot_papers",
    "indicative_cross_field_score",
    "esi_field",
)
NEVER_NULL = ("name", "esi_field")
DUPLICATE_KEYS = ("name", "esi_field")
ANALYSED = ("times_cited", "highly_cited_papers", "hot_papers", "indicative_cross_field_score")
TYPE_CHECKED = ("times_cited", "highly_cited_papers", "hot_papers", "rank")
Z_THRESHOLD = 3.0
FLOAT_TOLERANCE = 0.001

METRICS = (
    Metric("highly_cited_papers"),
    Metric("indicative_cross_field_score", FLOAT_TOLERANCE),
    Metric("hot_papers"),
    Metric("times_cited"),
)


def researcher_spec(**changes) -> CompareSpec:
    settings = dict(metrics=METRICS, periods=PERIODS, carry=("esi_field",)) | changes
    return CompareSpec(**settings)


def researcher_transform(**changes) -> LightTransform:
    settings = dict(
        column_mapping=COLUMN_MAPPING,
        schema=SNAPSHOT_SCHEMA,
        category_column="esi_field",
        canonical=CANONICAL_FIELDS,
        duplicate_keys=DUPLICATE_KEYS,
        critical=CRITICAL,
        never_null=NEVER_NULL,
        null_defaults=NULL_DEFAULTS,
        rules=RULES,
        numeric=TYPE_CHECKED,
    ) | changes
    return LightTransform(**settings)
