"""External references: deprivation scores of areas, and one table of schools out of yearly files."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions import coerce, labels
from annalist.operators import joins, profile

# What score columns are told by, what they must not tell, and their short names.
SCORE_TAG = "Score"
LEFT_OUT = ["IDACI", "IDAOPI"]
SCORE_NAMES = {
    "Index of Multiple Deprivation (IMD) Score": "imd_score",
    "Index of Multiple Deprivation (IMD) Decile (where 1 is most deprived 10% of LSOAs)": "imd_decile",
    "Income Score (rate)": "income_rate",
    "Employment Score (rate)": "employment_rate",
    "Education, Skills and Training Score": "education_skills_score",
    "Health Deprivation and Disability Score": "health_disability_score",
    "Crime Score": "crime_score",
    "Barriers to Housing and Services Score": "housing_barriers_score",
    "Living Environment Score": "living_env_score",
    "Children and Young People Sub-domain Score": "children_young_people_sub_score",
    "Adult Skills Sub-domain Score": "adult_skills_sub_score",
    "Geographical Barriers Sub-domain Score": "geo_barriers_sub_score",
    "Wider Barriers Sub-domain Score": "wider_barriers_sub_score",
    "Indoors Sub-domain Score": "indoors_sub_score",
    "Outdoors Sub-domain Score": "outdoors_sub_score",
}
# What inspection ratings stand for.
RATINGS = {1: "Outstanding", 2: "Good", 3: "Requires improvement", 4: "Inadequate"}


def score_columns(columns: list[str], decile: str, prefix: str = "", names: dict[str, str] | None = None) -> dict[str, str]:
    """Score and decile columns of a deprivation table, and the names that they get: short ones, else cleaned ones."""
    names = SCORE_NAMES if names is None else names
    kept = [c for c in columns if (SCORE_TAG in c or decile in c) and not any(x in c for x in LEFT_OUT)]
    clean = lambda c: labels.standard_column_names([c.replace("(", " ").replace(")", " ")], {})[0]
    return {c: f"{prefix}{names.get(c) or clean(c)}" for c in kept}


def with_deprivation(df: DataFrame, postcode: str, areas: DataFrame, scores: DataFrame, area_postcode: str, area: str, score_area: str, decile: str, order: list[str], prefix: str = "") -> DataFrame:
    """df with the deprivation scores of the area that its postcode lies in; null where one is not known. In both tables the last row of a key, by order, counts."""
    values = score_columns(scores.columns, decile, prefix)
    cleaned = areas.withColumn("_postcode", coerce.postcode(F.col(area_postcode)))
    return joins.two_hop(df, cleaned, scores, coerce.postcode(F.col(postcode)), "_postcode", area, score_area, values, order)


def _joined(frames: list[DataFrame], keys: list[str], year: int) -> DataFrame:
    """The frames joined on the keys that each has in common with those before it. Rows without any of these go first: they would only meet each other. Frames of the same keys meet in one exchange."""
    out, at = frames[0], 1
    while at < len(frames):
        common = [k for k in keys if k in out.columns and k in frames[at].columns]
        if not common:
            raise ValueError(f"files of {year} have none of the keys {keys} in common")
        end, held = at, set(out.columns)
        while end < len(frames) and [k for k in keys if k in held and k in frames[end].columns] == common:
            held |= set(frames[end].columns)
            end += 1
        out = joins.outer_coalesce([df.dropna("all", subset=common) for df in [out, *frames[at:end]]], common)
        at = end
    return out


def school_year(frames: list[DataFrame], keys: list[str], year: int, year_col: str = "acad_end_year") -> DataFrame:
    """The files of one year as one table of schools: full outer joins on the keys that both sides have, as numbers, rows without any key left out, columns that several have coalesced; percents and rates scaled, and checked to be in range; ratings named."""
    out = _joined([df.withColumns({k: coerce.numeric(F.col(k)) for k in keys if k in df.columns}) for df in frames], keys, year)
    percents, rates = ([c for c in out.columns if c.lower().endswith(x)] for x in ("pct", "rate"))
    out = profile.scale_percents(out, percents) if percents else out
    out = profile.scale_rates(out.withColumns({c: coerce.numeric(F.col(c)) for c in rates}), rates) if rates else out
    if percents or rates:
        ranges = {c: (0.0, 100.0) for c in percents} | {c: (0.0, 1.0) for c in rates}
        if bad := [r["column_name"] for r in profile.out_of_range(out, ranges).where("n_bad > 0").collect()]:
            raise ValueError(f"out of range in {year}: {bad}")
    if "ofsted_rating" in out.columns:
        rating = coerce.integer(F.col("ofsted_rating"))
        out = out.withColumn("ofsted_rating", F.create_map(*[F.lit(x) for kv in RATINGS.items() for x in kv])[rating])
    return out.withColumn(year_col, F.lit(str(year))).distinct()


def school_table(years: dict[int, list[DataFrame]], keys: list[str] = ("urn", "estab_no"), year_col: str = "acad_end_year") -> DataFrame:
    """The tables of all years as one, with missing columns as nulls and no row twice."""
    parts = [school_year(frames, list(keys), year, year_col) for year, frames in sorted(years.items()) if frames]
    if not parts:
        raise ValueError("no files of any year")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).distinct()
