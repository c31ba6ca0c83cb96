"""Facades: raw extracts to one longitudinal table, and from there to resolved features."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.catalog import SchemaCatalog
from annalist.functions import labels
from annalist.operators import clean, derive, guards, joins, merging, references, resolve, schemas
from annalist.operators.checks import Checks
from annalist.operators.merging import longitudinal
from annalist.sources import files
from annalist.sources.store import Store, Table, stamp_of


@dataclass
class Curator:
    """Raw tables of several categories to one longitudinal table."""

    spark: SparkSession
    id_col: str
    catalog: SchemaCatalog
    options: clean.CleanOptions | None = None
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    findings: dict[str, list[guards.Finding]] = field(default_factory=dict)

    def standardise(self, df: DataFrame) -> DataFrame:
        names = labels.standard_column_names(df.columns)
        if len(set(names)) < len(names):
            df, names = files.without_empty_twins(df, names)
        return df.toDF(*names)

    def curate(self, category: str, df: DataFrame, strict: bool = True, **options) -> DataFrame:
        """Standard names, cleaned rows, types of the catalogue (what they lose is an error, or noted in `findings`; options of `guards.typed`), and the category's prefix."""
        if category.startswith("~"):
            raise ValueError(f"{category} is marked as unused")
        kept, bad = clean.clean(clean.replace_ampersand(self.standardise(df)), self.options or clean.CleanOptions(self.id_col))
        self.rejected[category] = bad
        typed, self.findings[category] = self.catalog.guarded(category, kept, strict, **options)
        return self.catalog.prefix(category, typed, self.id_col)

    def standardise_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Tables by category with standard column names; those marked `~` are skipped, and values must not change."""
        out = {}
        for category, df in tables.items():
            if category.startswith("~"):
                continue
            named = self.standardise(df)
            if len(named.columns) == len(df.columns) and schemas.profile_changed(df, named):
                raise ValueError(f"renaming changed values of {category}")
            out[category] = named
        return out

    def clean_files(self, frames: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
        """All files of a category as one job: kept rows, rejected rows, column metadata."""
        return clean.clean_files({n: clean.replace_ampersand(self.standardise(df)) for n, df in frames.items()}, self.options or clean.CleanOptions(self.id_col))

    def merge(self, frames: list[DataFrame], left_keys: list[str] | None = None, right_keys: list[str] | None = None) -> DataFrame:
        """Frames of one cohort, each joined by the key that fits best."""
        return reduce(lambda a, b: joins.best_key_join(a, b, self.id_col, left_keys, right_keys), frames)

    def merge_cohort(self, year_group: int, frames: dict[str, DataFrame], destinations: merging.Destinations | None = None, **options) -> list[merging.Merged]:
        """A cohort's curated tables as one for each age; see `merging.merge_cohort`."""
        return merging.merge_cohort(year_group, frames, destinations, merging.MergeOptions(self.id_col, **options))

    def unite(self, parts: list[tuple[str, int, DataFrame]], **options) -> DataFrame:
        return longitudinal(parts, **options)

    def unite_alike(self, parts: list[tuple[str, int, DataFrame]], **options) -> list[DataFrame]:
        """A longitudinal table for each group of cohorts with alike columns."""
        return merging.merge_all(parts, **options)


@dataclass
class SourceFile:
    """A file of the inventory: what it holds, and of whom."""

    path: str
    category: str
    cohort: str
    year_group: int


@dataclass
class Orchestrator:
    """From an inventory of files to longitudinal tables, as a graph of written tables: files, curated tables, cohorts, unions. Each is written once, and again only when something that it is made of has changed: a file's size or time, or the options."""

    curator: Curator
    store: Store
    #: The files of later records, and how their columns are named.
    destinations: str | None = None
    columns: dict[str, str] = field(default_factory=dict)
    merge: dict = field(default_factory=dict)
    similarity: float = 0.7
    subset: float = 0.5
    strategy: merging.Strategy | None = "strict"

    def curated(self, source: SourceFile) -> Table:
        """A file's table with standard names, types of the catalogue and its category's prefix."""
        inputs = [self.store.file_stamp(source.path), source.category, self.curator.id_col, repr(self.curator.options), self.curator.catalog.types.get(source.category), self.curator.catalog.prefixes]
        return self.store.table(f"curated/{stamp_of(source.path)}", inputs, lambda: self.curator.curate(source.category, files.load(self.curator.spark, source.path)))

    def cohort(self, cohort: str, year_group: int, sources: list[SourceFile]) -> list[tuple[int, Table]]:
        """(year group, table) for each age of a cohort's merge."""
        tables = {s.category: self.curated(s) for s in sources}
        if len(tables) < len(sources):
            raise ValueError(f"{cohort}, year group {year_group} has several files of one category")
        later = self.store.file_stamp(self.destinations) if self.destinations else None
        inputs = [{c: t.stamp for c, t in tables.items()}, list(tables), later, self.columns, repr(sorted(self.merge.items()))]
        name = f"cohort/{cohort}-{year_group}"

        def make(stamp: str) -> dict[str, Table]:
            frames = {c: t.read(self.store.spark) for c, t in tables.items()}
            facts = files.load(self.store.spark, self.destinations) if self.destinations else None
            parts = merging.merge_cohort(year_group, frames, facts and merging.Destinations(facts, **self.columns), merging.MergeOptions(self.curator.id_col, **self.merge), self.store, name, stamp)
            return {f"{m.year_group}/{m.age}": m.table for m in parts}

        return [(int(k.split("/")[0]), t) for k, t in self.store.tables(name, inputs, make).items()]

    def run(self, inventory: list[SourceFile]) -> list[DataFrame]:
        """The longitudinal tables, one for each group of cohorts with alike columns (one of all with strategy None), sorted by id, cohort and year group within files. Categories marked `~` are left out. `store.made` tells what had to be made."""
        used = [s for s in inventory if not s.category.startswith("~")]
        if not used:
            raise ValueError("an empty inventory")
        parts = []
        for cohort, group in sorted({(s.cohort, s.year_group) for s in used}, key=lambda x: (int(x[0].split("-")[0]), x[1])):
            parts += [(cohort, g, t) for g, t in self.cohort(cohort, group, [s for s in used if (s.cohort, s.year_group) == (cohort, group)])]
        columns = [set(t.columns if t.columns is not None else t.schema.names) for *_, t in parts]
        groups = [list(range(len(parts)))] if self.strategy is None else merging.column_groups(columns, self.similarity, self.subset, self.strategy)
        out = []
        for places in groups:
            chosen = [parts[i] for i in places]
            inputs = [[(c, g, t.stamp) for c, g, t in chosen], self.curator.id_col]
            read = lambda chosen=chosen: merging.longitudinal([(c, g, t.read(self.store.spark)) for c, g, t in chosen], order=self.curator.id_col)
            out.append(self.store.table("longitudinal", inputs, read).read(self.store.spark))
        return out


@dataclass
class Engineer:
    """Features of a longitudinal table."""

    df: DataFrame
    id_col: str
    time: str

    def link(self, table: DataFrame, refs: dict, year: str, table_year: str, path: str | None = None) -> "Engineer":
        """With each reference's values of its lag before, empty columns left out. That keys are unique and years lie back by the lag is checked; with a path, in the one job that writes the result there."""
        checks = Checks() if path else None
        out = joins.lagged_lookups(self.df, table, refs, year, table_year, True, checks)
        return Engineer(checks.stored(out, path) if path else out, self.id_col, self.time)

    def deprivation(self, postcode: str, areas: DataFrame, scores: DataFrame, values: dict[str, str], order: list[str]) -> "Engineer":
        from annalist.functions.coerce import postcode as cleaned

        out = joins.two_hop(self.df, areas, scores, cleaned(F.col(postcode)), "postcode", "area", "area", values, order)
        return Engineer(out, self.id_col, self.time)

    def with_scores(self, postcode: str, areas: DataFrame, scores: DataFrame, area_postcode: str, area: str, score_area: str, decile: str, order: list[str], prefix: str = "") -> "Engineer":
        """The deprivation scores of the area that a postcode lies in, columns found by their names."""
        out = references.with_deprivation(self.df, postcode, areas, scores, area_postcode, area, score_area, decile, order, prefix)
        return Engineer(out, self.id_col, self.time)

    def histories(self, attributes: dict[str, list[str]], prefix: str = "der_", threshold: int = 2) -> "Engineer":
        told = derive.set_histories(self.df, self.id_col, self.time, attributes, prefix, threshold)
        return Engineer(joins.null_safe_join(self.df, told, [self.id_col, self.time]), self.id_col, self.time)

    def derive(self, steps: dict[str, dict], prefix: str = "der") -> tuple["Engineer", dict[str, DataFrame]]:
        """The features that are asked for and not there yet, and the reports made on the way; see `derive.derive_features`."""
        df, reports = derive.derive_features(self.df, self.id_col, self.time, steps, prefix)
        return Engineer(df, self.id_col, self.time), reports

    def resolve(self, keys: list[str], rules: list[resolve.Rule]) -> "Engineer":
        return Engineer(resolve.verified(resolve.resolve(self.df, self.id_col, keys, rules), keys), self.id_col, self.time)
