"""All tables of the reporting warehouse, layer by layer, and their refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldtally.forms import FORMS, FormSpec
from fieldtally.operators.changes import STATE, changed, digests, read_state
from fieldtally.operators.ingest import clean_form
from fieldtally.operators.publish import (
    LAYERS, current_version, ensure_namespaces, in_months, publish, publish_alias, publish_projection, published_rows,
)
from fieldtally.operators.relate import cutoff
from fieldtally.operators.repeat import explode_group, parsed_group
from fieldtally.plans import immunization, monitoring, rapid_coverage, readiness, social
from fieldtally.plans.dims import Dimensions
from fieldtally.sources import rename_choices


@dataclass(frozen=True)
class Inputs:
    """Landed forms and choice tables by form name, dimensions, calendar, and the day reports are as of.

    ``specs`` declares the forms: a country changes questions, groups or types with
    ``dataclasses.replace`` and reads malformed text as NULL with ``spec.lenient()``. The two counts are
    how many question categories make a complete readiness assessment and a complete monitoring visit.
    """

    forms: dict[str, DataFrame]
    choices: dict[str, DataFrame]
    dims: Dimensions
    spine: DataFrame
    as_of: date | str | None = None
    specs: dict[str, FormSpec] = field(default_factory=lambda: dict(FORMS))
    readiness_categories: int = readiness.CATEGORIES
    monitoring_categories: int = monitoring.CATEGORIES


Get = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Table:
    """One table: how to build it, the day its partitions follow and the form whose day that is, columns that are
    written for the refresh but not shown, sources it reads beside its tables and the dimensions, whether
    it only renames another table or shows the listed columns of another, and what makes those hidden columns that
    are made from the others as the table is written. ``narrow`` and ``expand`` are ``build`` in two steps: fewer rows, and
    the table's rows from them with some columns kept, which a write does behind its shuffle by month."""

    name: str
    build: Callable[[Get, Inputs], DataFrame]
    month_of: str | None = None
    follows: str | None = None
    hidden: tuple[str, ...] = ()
    reads: tuple[str, ...] = ()
    same_as: str | None = None
    shown_from: tuple[str, tuple[str, ...]] | None = None
    late: Callable[[Inputs], dict[str, Column]] | None = None
    narrow: Callable[[Get, Inputs], DataFrame] | None = None
    expand: Callable[[DataFrame, Inputs, Sequence[str]], DataFrame] | None = None


#: Day of a repeat row's submission, by which its table is partitioned.
SUBMITTED_DAY = "submission_day"


def parsed_column(column: str) -> str:
    """The hidden column that holds a repeat group parsed."""
    return f"{column}_rows"


def _repeat(form: str, column: str, day: str | None, *keys: str) -> Table:
    """The rows of a form's repeat group with the listed keys."""
    def build(get: Get, src: Inputs) -> DataFrame:
        clean = get(f"clean.{form}")
        kept = [*keys, SUBMITTED_DAY] if day else keys
        if day:
            clean = clean.withColumn(SUBMITTED_DAY, F.col(day).try_cast("date"))
        rows = explode_group(clean, src.specs[form].repeat, kept, column=column)
        return rows.select(*[c for c in rows.columns if c not in kept], *kept)

    name = {"vaccine": "activity_vaccine", "target_children": "target_children", "refusals": "social_refusals",
            "vaccination": "rapid_coverage_vaccination", "vaccination_team_info": "monitoring_team_info"}[column]
    if day is None:
        return Table(f"clean.{name}", build)
    return Table(f"clean.{name}", build, month_of=SUBMITTED_DAY, follows=form, hidden=(SUBMITTED_DAY,))


def _clean(name: str, day: str | None = None, group: str | None = None) -> Table:
    """The clean form; its repeat group is parsed once and stored beside the text."""
    def build(get: Get, src: Inputs) -> DataFrame:
        return clean_form(src.forms[name], src.specs[name])

    def late(src: Inputs) -> dict[str, Column]:
        return {parsed_column(group): parsed_group(src.specs[name].repeat, group)} if group else {}

    return Table(f"clean.{name}", build, month_of=day, follows=name if day else None,
                 hidden=(parsed_column(group),) if group else (), reads=(name,), late=late)


def _choices(name: str) -> Callable[[Get, Inputs], DataFrame]:
    return lambda get, src: rename_choices(src.choices[name])


def _same(name: str, as_: str) -> Table:
    return Table(name, lambda get, src: get(as_), same_as=as_)


def _shown(name: str, source: str, columns: Sequence[str], build: Callable[[DataFrame], DataFrame]) -> Table:
    return Table(name, lambda get, src: build(get(source)), shown_from=(source, tuple(columns)))


#: Columns that reporting views show as dates.
STAMPS = ("submitted_at", "modified_at")
DAY = "date_vaccination_activity"
RAW_KEYS = ("_airbyte_ab_id", "_airbyte_emitted_at")

TABLES: tuple[Table, ...] = (
    Table("clean.readiness_labels", _choices("readiness"), reads=("readiness_choices",)),
    _clean("readiness", "assessment_date"),
    Table("staging.hc_assessment",
          lambda get, src: readiness.question_answers(get("clean.readiness"), src.dims, src.specs["readiness"])),
    Table("staging.hcl_monitoring_assessment",
          lambda get, src: readiness.assessment(get("clean.readiness"), src.dims, src.specs["readiness"])),
    Table("staging.ready_facilities",
          lambda get, src: readiness.ready_facilities(
              get("clean.readiness"), src.dims, src.specs["readiness"], src.readiness_categories)),
    _shown("public.hcl_monitoring_assessment", "staging.hcl_monitoring_assessment",
           readiness.ASSESSMENT_COLUMNS, readiness.public_assessment),
    _same("public.ready_facilities", "staging.ready_facilities"),

    Table("clean.rca_labels", _choices("rapid_coverage"), reads=("rapid_coverage_choices",)),
    _clean("rapid_coverage", "rca_date", "vaccination"),
    _repeat("rapid_coverage", "vaccination", "rca_date", *RAW_KEYS),
    Table("staging.rca_actuals",
          lambda get, src: rapid_coverage.children(
              get("clean.rapid_coverage"), src.dims, get("clean.rca_labels"), src.specs["rapid_coverage"]),
          month_of="rca_date", follows="rapid_coverage"),
    Table("staging.rca",
          lambda get, src: rapid_coverage.submissions(
              get("clean.rapid_coverage"), src.dims, get("clean.rca_labels"), src.specs["rapid_coverage"]),
          month_of="rca_date", follows="rapid_coverage"),
    Table("staging.rca_sources_info",
          lambda get, src: rapid_coverage.information_sources(
              get("clean.rapid_coverage"), src.dims, get("clean.rca_labels")),
          month_of="rca_date", follows="rapid_coverage"),
    Table("staging.rca_not_vaccinated_reasons",
          lambda get, src: rapid_coverage.not_vaccinated_reasons(
              get("clean.rapid_coverage"), src.dims, get("clean.rca_labels"), src.specs["rapid_coverage"]),
          month_of="rca_date", follows="rapid_coverage"),
    _same("public.rca_actuals", "staging.rca_actuals"),
    _shown("public.rca", "staging.rca",
           rapid_coverage.PUBLIC_COLUMNS, rapid_coverage.public_submissions),
    _same("public.rca_sources_info", "staging.rca_sources_info"),
    _same("public.rca_not_vaccinated_reasons", "staging.rca_not_vaccinated_reasons"),

    Table("clean.sia_labels", _choices("activity"), reads=("activity_choices",)),
    _clean("activity", DAY, "vaccine"),
    _repeat("activity", "vaccine", DAY, "_airbyte_ab_id"),
    _clean("target", "campaign_start_date", "target_children"),
    _repeat("target", "target_children", "campaign_start_date", "_airbyte_ab_id"),
    Table("staging.sia_actuals",
          lambda get, src: immunization.actuals(get("clean.activity"), src.dims, src.specs["activity"]),
          month_of=DAY, follows="activity",
          narrow=lambda get, src: immunization.named_submissions(get("clean.activity"), src.dims, src.specs["activity"]),
          expand=lambda rows, src, keep: immunization.expanded_actuals(rows, src.specs["activity"], keep)),
    Table("staging.sia_targets", lambda get, src: immunization.targets(get("clean.target"), src.dims, src.specs["target"])),
    Table("staging.sia_vaccine_dose",
          lambda get, src: immunization.doses(get("clean.activity"), src.dims), month_of=DAY, follows="activity"),
    Table("staging.aggregated_sia_actuals_target",
          lambda get, src: immunization.daily_against_target(
              get("clean.activity"), get("staging.sia_targets"), get("staging.sia_vaccine_dose"), src.dims,
              src.spine, src.as_of, src.specs["activity"]),
          month_of="date", follows="activity", reads=("calendar",)),
    Table("staging.sia_actuals_target",
          lambda get, src: immunization.daily_by_age_group(
              get("clean.activity"), get("staging.sia_targets"), src.dims, src.spine, src.as_of, src.specs["activity"]),
          month_of="date", follows="activity", reads=("calendar",)),
    Table("staging.deferred_refused_reasons",
          lambda get, src: immunization.unreached_reasons(get("clean.activity"), src.dims, src.specs["activity"]), month_of=DAY, follows="activity"),
    Table("staging.sia_records",
          lambda get, src: immunization.records(get("clean.activity"), src.dims), month_of=DAY, follows="activity"),
    _same("public.sia_actuals", "staging.sia_actuals"),
    _same("public.aggregated_sia_actuals_target", "staging.aggregated_sia_actuals_target"),
    _same("public.sia_actuals_targets", "staging.sia_actuals_target"),
    _same("public.sia_deferred_refused_reasons", "staging.deferred_refused_reasons"),
    _shown("public.sia_records", "staging.sia_records",
           immunization.RECORD_COLUMNS, immunization.public_records),

    _clean("social", "assessment_date", "refusals"),
    _repeat("social", "refusals", "assessment_date", "id"),
    Table("staging.social_mobilization_indicators",
          lambda get, src: social.indicators(get("clean.social"), src.dims, spec=src.specs["social"]),
          month_of="assessment_date", follows="social"),
    _shown("public.social_mobilization_indicators", "staging.social_mobilization_indicators",
           social.COLUMNS, social.public_indicators),

    _clean("monitoring", DAY, "vaccination_team_info"),
    _repeat("monitoring", "vaccination_team_info", DAY, *RAW_KEYS),
    Table("staging.microplan_vaccine_management",
          lambda get, src: monitoring.visit_questions(get("clean.monitoring"), src.dims, src.specs["monitoring"])),
    Table("staging.vaccination_site_questions_monitoring_tool",
          lambda get, src: monitoring.team_questions(get("clean.monitoring"), src.dims, src.specs["monitoring"])),
    Table("staging.monitoring_tool",
          lambda get, src: monitoring.monitoring_tool(get("clean.monitoring"), src.dims, src.specs["monitoring"]), month_of=DAY, follows="monitoring"),
    Table("staging.monitored_facilities_overall_proportion",
          lambda get, src: monitoring.facility_scores(
              get("clean.monitoring"), src.dims, src.monitoring_categories, src.specs["monitoring"]), month_of=DAY, follows="monitoring"),
    Table("staging.vaccinated_children_under_monitoring_tool",
          lambda get, src: monitoring.vaccinated_children(get("clean.monitoring"), src.dims), month_of=DAY, follows="monitoring"),
    _same("public.monitoring_tool", "staging.monitoring_tool"),
    _same("public.monitored_facilities_overall_proportion", "staging.monitored_facilities_overall_proportion"),
    _shown("public.vaccinated_children_under_monitoring_tool", "staging.vaccinated_children_under_monitoring_tool",
           monitoring.CHILDREN_COLUMNS, monitoring.public_vaccinated_children),
)


#: What the labels, scores and daily totals of the staging layer are looked up in.
_DIMENSIONS = ("admin1", "admin2", "admin3", "admin4", "admin5", "iso", "indicators", "readiness_questions",
               "monitoring_questions")


#: Digests of all sources as of the last refresh by change.
STATE_TABLE = "clean.refresh_state"


@dataclass
class Warehouse:
    """Lazy access to every table; published tables are read back instead of recomputed.

    Several warehouses share a catalog under different ``suffix``es of their namespaces (``clean_za.activity``);
    ``location`` is the folder of the namespaces that have to be created.
    """

    inputs: Inputs
    frames: dict[str, DataFrame] = field(default_factory=dict)
    published: set[str] = field(default_factory=set)
    suffix: str = ""
    location: str | None = None

    def catalog_name(self, name: str) -> str:
        """Where readers find a table."""
        layer, table = name.split(".")
        return f"{layer}{self.suffix}.{table}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            table = _BY_NAME[name]
            self.frames[name] = table.build(self.__getitem__, self.inputs).drop(*table.hidden)
        return self.frames[name]

    def refresh(self, spark: SparkSession, names: Sequence[str] | None = None, mode: str = "view",
                since: str | None = None) -> dict[str, DataFrame]:
        """Publish the named tables (all by default) in dependency order; run it on a schedule.

        In table mode every later table reads the written earlier ones: each landed form is parsed
        once, its repeat group included, and a lost executor costs at most the tasks of the table being written. Tables that rename
        or show another become catalog views of it, for all sessions. ``since`` limits the rewrite of
        month-partitioned tables, and what they read of such tables, to that month and later and to rows
        without a day; it has to reach back to the earliest day, old or new, of a submission changed
        since the last refresh. ``refresh_changed`` finds the months itself.
        """
        if mode == "table":
            self._namespaces(spark)
        for table in TABLES:
            if names is None or table.name in names:
                self._publish(spark, table, mode, since=since)
        return {t.name: self.frames[t.name] for t in TABLES if t.name in self.frames}

    def refresh_changed(self, spark: SparkSession, names: Sequence[str] | None = None, state: str = STATE_TABLE,
                        stamps: Mapping[str, Sequence[str]] | None = None) -> dict[str, set[date | None] | None]:
        """Publish what changed since the last call: the months rewritten of each table, None for a whole table.

        Every source is digested by month and compared with the digests of the last call (``state`` keeps them, one state for
        one set of ``names``). A table whose months follow a form's day is rewritten in the months in which
        that form changed, edited, moved, undated and vanished submissions included; a table that has no day, or
        reads another changed source, such as a dimension, is rewritten in full; others are left alone. ``stamps`` lists, by form,
        landed columns that change whenever a submission does, which makes the digest a narrow scan.

        Digests are taken before anything is written and kept after everything is, so what changes in
        between, or is left over by a failure, is found by the next call.
        """
        self._namespaces(spark)
        wanted = [t for t in TABLES if names is None or t.name in names]
        sources = {t.name: self.sources(t.name) for t in wanted}
        now = self._digests(set().union(*sources.values()), stamps or {})
        state = self.catalog_name(state)
        moved = changed(now, read_state(spark, state))
        done: dict[str, set[date | None] | None] = {}
        for table in wanted:
            mine = {s: moved[s] for s in sources[table.name] if s in moved}
            public = self.catalog_name(table.name)
            there = spark.catalog.tableExists(public)
            if not mine and there:
                self.frames[table.name] = spark.table(public)
                self.published.add(table.name)
                continue
            months: set[date | None] | None = set()
            for source, days in mine.items():
                local = source in (table.follows, "calendar") and table.month_of
                months = months | days if local and days is not None and months is not None else None
            source = table.same_as or (table.shown_from or (None,))[0]
            self._publish(spark, table, "table", months=months if there else None)
            done[table.name] = done.get(source, months) if source else months if there else None
        if moved:
            publish(spark.createDataFrame(now, STATE), state, "table")
        return done

    def _namespaces(self, spark: SparkSession) -> None:
        ensure_namespaces(spark, [f"{layer}{self.suffix}" for layer in LAYERS], self.location)

    def sources(self, name: str) -> frozenset[str]:
        """The forms, choices, dimensions and calendar that a table is built from. Frames are built for it, no job is run."""
        table, met = _BY_NAME[name], set()

        def get(read: str) -> DataFrame:
            met.add(read)
            return self[read]

        table.build(get, self.inputs)
        own = {*table.reads, *(_DIMENSIONS if name.startswith("staging.") else ())}
        return frozenset(own.union(*[self.sources(read) for read in met]))

    def _digests(self, sources: set[str], stamps: Mapping[str, Sequence[str]]) -> list[Row]:
        """Digests of the named sources, one row a source and month."""
        src = self.inputs
        calendar = cutoff(src.spine, "date", src.as_of)
        frames = {"calendar": digests(calendar, "calendar", "date")}
        for name, choices in src.choices.items():
            frames[f"{name}_choices"] = digests(choices, f"{name}_choices")
        for level, area in src.dims.areas.items():
            frames[f"admin{level}"] = digests(area, f"admin{level}")
        for name in ("iso", "indicators", "readiness_questions", "monitoring_questions"):
            frames[name] = digests(getattr(src.dims, name), name)
        for name, form in src.forms.items():
            frames[name] = digests(form, name, _landed_day(name, src.specs[name]), stamps.get(name))
        wanted = [frames[s] for s in sorted(sources)]
        return reduce(DataFrame.unionByName, wanted).collect() if wanted else []

    def _publish(self, spark: SparkSession, table: Table, mode: str, since: str | None = None,
                 months: set[date | None] | None = None) -> None:
        """Publish one table, or its rows since a month, or of the given months."""
        name = self.catalog_name(table.name) if mode == "table" else table.name
        source, columns = table.shown_from or (table.same_as, ())
        if mode == "table" and source in self.published:
            if table.shown_from:
                frame = publish_projection(spark, name, self.catalog_name(source), columns, STAMPS)
            else:
                frame = publish_alias(spark, name, self.catalog_name(source), self[source].columns)
        else:
            inputs = self.inputs
            if months is not None and table.name == f"clean.{table.follows}":
                inputs = _only_months(inputs, table.follows, months)
            get, expand = self._reader(spark, table, mode, since, months), None
            if table.expand and mode == "table":
                frame, expand = table.narrow(get, inputs), lambda rows, keep: table.expand(rows, inputs, keep)
            else:
                frame = table.build(get, inputs)
            frame = publish(frame, name, mode, table.month_of, since, months=months, hidden=table.hidden,
                            late=table.late(self.inputs) if table.late else None, expand=expand)
        self.frames[table.name] = frame
        self.published.add(table.name)

    def _reader(self, spark: SparkSession, table: Table, mode: str, since: str | None,
                months: set[date | None] | None) -> Get:
        """What ``table`` is built from: written tables with their repeat groups parsed, and of those that follow
        the same day only the months that are replaced."""
        def get(name: str) -> DataFrame:
            source = _BY_NAME[name]
            written = self.catalog_name(name)
            if mode != "table" or name not in self.published or current_version(spark, written) is None:
                return self[name]
            same_day = table.follows is not None and source.follows == table.follows
            rows = published_rows(spark, written, source.month_of, since if same_day else None, months if same_day else None)
            shown = self[name].columns
            return rows.select(*[
                F.col(parsed_column(c)).alias(c) if parsed_column(c) in source.hidden else F.col(f"`{c}`") for c in shown])
        return get


def _landed_day(form: str, spec: FormSpec) -> str | None:
    """The landed column that holds the day by which the clean form is partitioned."""
    day = _BY_NAME[f"clean.{form}"].month_of
    return next((landed for landed, clean, _ in spec.clean_columns() if clean == day), None)


def _only_months(inputs: Inputs, form: str, months: set[date | None]) -> Inputs:
    """The inputs with a landed form's submissions of the given months only."""
    day = _landed_day(form, inputs.specs[form])
    rows = in_months(inputs.forms[form], F.trunc(F.col(f"`{day}`").try_cast("date"), "month"), months)
    return replace(inputs, forms={**inputs.forms, form: rows})


_BY_NAME = {t.name: t for t in TABLES}
