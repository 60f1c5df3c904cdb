"""Rule documents and rule versions with validity windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline import schemas
from perkline.defaults import CORE_RULE_KEYS, OPEN_START
from perkline.functions.dates import as_date

MODES_KEY = "sportive_transport_modes"
DOCUMENTS_PER_TASK = 2_000

RULE_COLUMNS = (
    "rule_version", "effective_from", "office_address", "bonus_rate", "wellbeing_days",
    "min_activities_per_year", "max_km_walk_run", "max_km_cycle_scooter_other",
    "sportive_transport_modes", "rules_payload", "loaded_at",
)


def _value_type(value: Column, text: Column) -> Column:
    """Type names as fixed by the parameter table; numbers are told by their text."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), "NoneType")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "str")
        .when(kind == "BOOLEAN", "bool")
        .when(text.rlike(r"^-?[0-9]+$"), "int")
        .otherwise("float")
    )


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: A value with its name, if it has one, or a mark that opens or closes; lists of plain numbers and words are one value.
_TOKEN = rf'(?:({_STRING})\s*+:\s*+)?+(\[[^\[\]{{}}"]*+\]|[\[\]{{}}]|{_STRING}|[^\[\]{{}},:"\s]++)[\s,]*+'
#: Behind a name, before a leaf, and between its path and its text. A JSON text holds no such characters.
_NAME, _LEAF, _TEXT = "\x01", "\x02", "\x03"


def json_leaves(document: Column) -> Column:
    """Leaves of a JSON text as an array of (path, text), by one pass of a stack machine over its tokens.

    A list is one leaf; inside it only brackets are counted. The state is kept in a few plain strings, as every step
    copies it: the names of the objects that are open, and the leaves so far. Names stay escaped until the end, so
    that no name can hold one of the separators.
    """
    start = F.struct(F.lit("").alias("open"), F.lit(0).alias("lists"), F.lit("").alias("leaves"))
    tokens = F.arrays_zip(*[F.regexp_extract_all(document, F.lit(_TOKEN), k).alias(n) for k, n in enumerate(("all", "name", "value"))])

    def step(state: Column, token: Column) -> Column:
        opened, lists, leaves, value = state["open"], state["lists"], state["leaves"], token["value"]
        name = token["name"].substr(F.lit(2), F.greatest(F.length(token["name"]) - 2, F.lit(0)))
        inner = F.concat(leaves, F.when((lists == 1) & (value == "]"), value).otherwise(token["all"]))
        leaf = F.concat(leaves, F.lit(_LEAF), opened, name, F.lit(_TEXT), value)
        return F.struct(
            F.when((lists > 0) | ~value.isin("{", "}"), opened)
             .when(value == "}", F.regexp_replace(opened, f"[^{_NAME}]*+{_NAME}$", ""))
             .otherwise(F.concat(opened, name, F.when(token["name"] == "", "").otherwise(_NAME))).alias("open"),
            (lists + F.when(value == "[", 1).when(value == "]", -1).otherwise(0)).alias("lists"),
            F.when(lists > 0, inner).when(value.isin("{", "}"), leaves).otherwise(leaf).alias("leaves"))

    def leaf(text: Column) -> Column:
        parts = F.split(text, _TEXT)
        path = F.translate(F.ltrim(parts[0], F.lit(_NAME)), _NAME, ".")
        unescaped = F.try_variant_get(F.parse_json(F.concat(F.lit('"'), path, F.lit('"'))), "$", "string")
        return F.struct(F.when(F.contains(path, F.lit("\\")), unescaped).otherwise(path).alias("path"), parts[1].alias("text"))

    found = F.split(F.aggregate(tokens, start, step, lambda state: state["leaves"]), _LEAF)
    return F.transform(F.filter(found, lambda x: x != ""), leaf)


def spread_documents(docs: DataFrame, key: str = "rule_version", documents_per_task: int = DOCUMENTS_PER_TASK) -> DataFrame:
    """Documents dealt to tasks by their number: flattening one takes far longer than reading it, and a table of few bytes
    would be read by one task."""
    return docs.repartition(max(1, -(-docs.count() // documents_per_task)), key)


def flatten_rules(docs: DataFrame, keys: Sequence[str] = ("rule_version",), payload: str = "rules_payload") -> DataFrame:
    """Flatten a table of JSON documents into (path, JSON value, type) rows.

    Objects recurse with dotted paths, lists are leaves, empty objects vanish; the plan is one generate step next
    to the scan, however deep the documents nest. Numbers keep what their text says: ``1.0`` is a float, and an
    integer of any size an int. A text that is not JSON fails the job; a NULL document is one NULL leaf without a path.
    """
    missing = F.array(F.struct(F.lit("").alias("path"), F.lit(None).cast("string").alias("text")))
    document = F.col(payload).cast("string")
    leaves = F.when(F.parse_json(document).isNull(), missing).otherwise(json_leaves(document))
    nodes = docs.select(*keys, F.inline(leaves))
    value = F.parse_json("text")
    text = F.from_json(F.concat(F.lit('{"v":'), F.col("text"), F.lit("}")), "map<string,string>")["v"]
    kind = _value_type(value, text)
    return nodes.select(
        *keys,
        F.col("path").alias("rule_path"),
        F.when(kind == "str", F.to_json(value)).otherwise(F.coalesce(text, F.lit("null"))).alias("rule_value_json"),
        kind.alias("value_type"),
    )


def missing_rule_keys(document: Column, required: Sequence[str] = CORE_RULE_KEYS) -> Column:
    """Array of required top-level keys the JSON document lacks."""
    present = F.coalesce(F.json_object_keys(document), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(k) for k in required]), present)


def require_rule_keys(docs: DataFrame, payload: str = "document", required: Sequence[str] = CORE_RULE_KEYS) -> DataFrame:
    """Fail the job on the first document that lacks required keys, naming them."""
    missing = missing_rule_keys(F.col(payload), required)
    message = F.concat(F.lit("rule document without its mandatory keys: "), F.array_join(missing, ", "))
    checked = F.when(F.size(missing) == 0, F.col(payload)).otherwise(F.raise_error(message).cast("string"))
    return docs.withColumn(payload, checked)


def split_rule_documents(docs: DataFrame, payload: str = "document") -> tuple[DataFrame, DataFrame]:
    """Lenient form: (complete documents, rejects with their missing keys)."""
    tagged = docs.withColumn("missing_keys", missing_rule_keys(F.col(payload)))
    complete = F.size("missing_keys") == 0
    return tagged.filter(complete).drop("missing_keys"), tagged.filter(~complete)


def normalize_rules_payload(document: Column) -> Column:
    """Add an empty mode list to a JSON object that has none; the rest of the text is kept."""
    has_modes = F.array_contains(F.coalesce(F.json_object_keys(document), F.array().cast("array<string>")), MODES_KEY)
    body = F.regexp_replace(document, r"\s*\}\s*$", "")
    separator = F.when(F.size(F.json_object_keys(document)) > 0, ",").otherwise("")
    return F.when(has_modes, document).otherwise(F.concat(body, separator, F.lit(f'"{MODES_KEY}":[]}}')))


def rules_wide(docs: DataFrame, payload: str = "document", loaded_at: str = "loaded_at") -> DataFrame:
    """Typed core columns plus the whole normalised document, one row per document."""
    parsed = docs.withColumn("_core", F.from_json(F.col(payload), schemas.RULE_DOCUMENT))
    modes = F.coalesce(F.col("_core")[MODES_KEY], F.array().cast("array<string>"))
    return parsed.select(
        *[F.col("_core")[k].alias(k) for k in CORE_RULE_KEYS],
        F.to_json(modes).alias(MODES_KEY),
        normalize_rules_payload(F.col(payload)).alias("rules_payload"),
        F.col(loaded_at).alias("loaded_at"),
    )


def rules_history(rules: DataFrame) -> DataFrame:
    """All versions; ``is_latest`` marks the last by effective date, load time and version (maybe a future one)."""
    order = F.struct("effective_from", "loaded_at", "rule_version")
    newest = rules.select(F.max(order).alias("_newest")).scalar()
    return rules.select(*RULE_COLUMNS, (order == newest).alias("is_latest"))


def _active_on(as_of: str | date | Column) -> Column:
    day, until = as_date(as_of), F.col("effective_to_exclusive")
    return (day >= F.col("effective_from")) & (until.isNull() | (day < until))


def rules_validity(rules: DataFrame, as_of: str | date) -> DataFrame:
    """Half-open validity windows ``[valid_from_inclusive, effective_to_exclusive)`` per version.

    The next version's start is the version's own day, unless it is the last of that day, and then
    the next distinct day. Days are pre-aggregated, so only one row per calendar day is ordered
    and broadcast, however many versions there are.
    """
    order = F.struct("loaded_at", "rule_version")
    by_day = Window.orderBy("effective_from")
    days = (
        rules.groupBy("effective_from")
        .agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
        .withColumn("_next_day", F.lead("effective_from").over(by_day))
        .withColumn("_is_first_day", F.row_number().over(by_day) == 1)
    )
    opens = F.col("_is_first_day") & (order == F.col("_first"))
    closes_day = order == F.col("_last")
    windows = rules.join(F.broadcast(days), "effective_from").select(
        "rule_version",
        "effective_from",
        F.when(opens, as_date(OPEN_START)).otherwise(F.col("effective_from")).alias("valid_from_inclusive"),
        F.when(closes_day, F.col("_next_day")).otherwise(F.col("effective_from")).alias("effective_to_exclusive"),
        *RULE_COLUMNS[2:],
    )
    return windows.withColumn("is_current", _active_on(as_of))


def rules_current(validity: DataFrame) -> DataFrame:
    """The version in force at ``as_of``: no row or one row."""
    return validity.filter("is_current").select(*RULE_COLUMNS)


def rules_active_at(validity: DataFrame, as_of: str | date) -> DataFrame:
    """Versions whose window, counted from ``effective_from``, covers the day."""
    return validity.filter(_active_on(as_of))


def rule_parameters_history(parameters: DataFrame, validity: DataFrame) -> DataFrame:
    """Key/value rows with the window of their version; here ``is_latest`` means current.

    The windows, one row per version, are the side to look up; the flattened rows look small to the optimizer and are not,
    so they must not be broadcast.
    """
    windows = validity.select(
        "rule_version", "effective_from", "effective_to_exclusive", F.col("is_current").alias("is_latest"))
    return parameters.join(windows.hint("shuffle_hash"), "rule_version").select(
        "rule_version", "effective_from", "effective_to_exclusive", "rule_path", "rule_value_json",
        "value_type", "loaded_at", "is_latest")


def rule_parameters_current(parameters_history: DataFrame) -> DataFrame:
    return parameters_history.filter("is_latest")
