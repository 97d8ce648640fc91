"""What a table's metadata says, and control tables gathered to it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.masking import KINDS, MaskRule
from siltbed.operators.ordered import LISTED, listed, pieces
from siltbed.operators.rules import Rule
from siltbed.operators.shape import ColumnSpec

HISTORY, MERGE, REPLACE, APPEND = "HISTORY", "MERGE", "REPLACE", "APPEND"
DETECT_HASH, DETECT_NONE = "HASH", "NONE"


@dataclass(frozen=True)
class EntitySpec:
    """One source table to load."""

    entity_id: int
    source_system: str
    source_table: str
    columns: Sequence[ColumnSpec]
    full_load: bool = False
    history: bool = False
    merging: bool = True
    soft_delete: bool = False
    mark_type: str | None = None
    #: columns that break ties of the mark, the largest wins; of the batch, not the target
    sequence: Sequence[str] = ()
    rules: Sequence[Rule] = ()
    masks: Mapping[str, MaskRule] = field(default_factory=dict)
    #: columns masked by a rule of the catalogue, by its name
    mask_names: Mapping[str, str] = field(default_factory=dict)
    catalogue: Mapping[str, MaskRule] = field(default_factory=dict)
    #: HASH: matched rows are updated where the record's hash differs; NONE: always
    change_detection: str = "HASH"

    @property
    def all_masks(self) -> dict[str, MaskRule]:
        """Masks by column: those named in the catalogue, and the entity's own, which come first."""
        return {c: self.catalogue[n] for c, n in self.mask_names.items() if n in self.catalogue} | dict(self.masks)

    @property
    def strategy(self) -> str:
        if self.history:
            return HISTORY
        if self.merging:
            return MERGE
        return REPLACE if self.full_load else APPEND

    @property
    def keys(self) -> list[str]:
        return [c.target for c in self.columns if c.key]

    @property
    def mark(self) -> str | None:
        return next((c.target for c in self.columns if c.mark), None)

    @property
    def hash_columns(self) -> list[str]:
        return [c.target for c in self.columns if c.hashed and not c.key]

    def problems(self) -> list[str]:
        """All that is wrong with the metadata, not just the first of it."""
        out = []
        names = [c.target.lower() for c in self.columns]
        if not self.columns:
            out.append("no columns")
        if len(set(names)) < len(names):
            out.append("a target column occurs twice")
        if self.strategy in (HISTORY, MERGE) and not self.keys:
            out.append(f"{self.strategy} needs a key")
        if self.history and self.full_load and self.soft_delete:
            out.append("soft deletes are for MERGE")
        if not self.full_load and not self.mark and self.strategy != HISTORY:
            out.append("an incremental load needs a mark")
        if self.mark and self.mark_type not in ("DATETIME", "NUMERIC", "STRING"):
            out.append(f"unknown mark type {self.mark_type!r}")
        out += [f"rule {r.name} is on unknown column {r.column}" for r in self.rules if r.column and r.column.lower() not in names]
        if self.change_detection not in (DETECT_HASH, DETECT_NONE):
            out.append(f"unknown change detection {self.change_detection!r}")
        if self.history and self.change_detection == DETECT_NONE:
            out.append("HISTORY needs change detection HASH")
        out += [f"a mask is on unknown column {c}" for c in (*self.masks, *self.mask_names) if c.lower() not in names]
        out += [f"column {c} names unknown mask rule {n}" for c, n in self.mask_names.items() if n not in self.catalogue]
        out += [f"column {c} has a mask of unknown type {m.rule_type!r}" for c, m in self.all_masks.items() if m.rule_type.upper() not in KINDS]
        out += [f"rule {r.name} has no expression" for r in self.rules if r.type == "CUSTOM" and not r.expression]
        out += [f"rule {r.name} is on unknown column {c}" for r in self.rules if r.type == "UNIQUE" for c in r.columns if c.lower() not in names]
        out += [f"unknown stage {r.stage!r} of rule {r.name}" for r in self.rules if r.stage not in ("PRE", "POST", "BOTH")]
        out += [f"unknown action {r.action!r} of rule {r.name}" for r in self.rules if r.action not in ("FAIL", "WARN", "IGNORE")]
        return out


def set_problems(specs: Sequence[EntitySpec]) -> list[str]:
    """All that is wrong with a control set: each entity's problems, and what two of them share."""
    out = [f"entity {s.entity_id} ({s.source_system}.{s.source_table}): {p}" for s in specs for p in s.problems()]
    for what, value in (("id", lambda s: s.entity_id), ("source", lambda s: f"{s.source_system}.{s.source_table}".lower())):
        counts = Counter(map(value, specs))
        out += [f"{what} {v} occurs {n} times" for v, n in sorted(counts.items(), key=str) if n > 1]
    return out


def mask_problems(columns: DataFrame, masks: DataFrame, entity: str = "entity_id", mask: str = "mask_id", active: str = "is_active") -> DataFrame:
    """(entity, problem) of columns (with target and mask) that name a mask rule which is not there or not active."""
    known = masks.where(F.col(active)).select(F.col(mask).alias("_mask")).distinct()
    lost = columns.where(F.col(mask).isNotNull()).join(known, F.col(mask) == F.col("_mask"), "left_anti")
    return lost.select(entity, F.concat(F.lit("column "), "target", F.lit(" names unknown mask rule "), F.col(mask).cast("string")).alias("problem"))


def method_problems(entities: DataFrame, entity: str = "entity_id", method: str = "change_detection", history: str = "has_history") -> DataFrame:
    """(entity, problem) of entities with an unknown change detection, or versioned without HASH."""
    own = F.coalesce(F.col(method), F.lit(""))
    unknown = F.when(~own.isin(DETECT_HASH, DETECT_NONE), F.lit("unknown change detection"))
    versioned = F.when(F.col(history) & (own != DETECT_HASH), F.lit("HISTORY needs change detection HASH"))
    return entities.select(entity, F.explode(F.array_compact(F.array(unknown, versioned))).alias("problem"))


def control_problems(entities: DataFrame, columns: DataFrame, entity: str = "entity_id") -> DataFrame:
    """(entity, problem) over control tables of any size: entities (with load_type, has_history, is_merged)
    without columns, merged or versioned without a key, incremental without a mark, with an unknown load
    type, or twice there; columns (with target, is_key, is_mark) that occur twice or have no entity."""
    own = columns.groupBy(entity, F.lower("target").alias("_t")).agg(F.count("*").alias("_n"), F.max("is_key").alias("_key"), F.max("is_mark").alias("_mark"))
    own = own.groupBy(entity).agg(F.count_if(F.col("_n") > 1).alias("_twice"), F.max("_key").alias("_key"), F.max("_mark").alias("_mark"), F.lit(True).alias("_any"))
    rows = entities.groupBy(entity).agg(F.count("*").alias("_rows"), F.max("load_type").alias("_load"), F.max("has_history").alias("_history"), F.max("is_merged").alias("_merged"))
    both = rows.join(own, entity, "full_outer")
    there, no = F.col("_rows").isNotNull(), lambda c: ~F.coalesce(c, F.lit(False))
    found = {
        "columns of no entity": ~there,
        "no columns": there & no(F.col("_any")),
        "the entity occurs twice": F.col("_rows") > 1,
        "a target column occurs twice": F.col("_twice") > 0,
        "no key": there & (F.col("_history") | F.col("_merged")) & no(F.col("_key")),
        "no mark": there & (F.col("_load") == "INCREMENTAL") & ~F.col("_history") & no(F.col("_mark")),
        "unknown load type": there & no(F.col("_load").isin("FULL", "INCREMENTAL")),
    }
    problems = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(p)) for p, c in found.items()]))
    return both.select(entity, F.explode(problems).alias("problem"))


def ordered_list(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, separator: str = ", ", limit: int = LISTED) -> DataFrame:
    """Each key's values as one text, in order: `listed`. A key of more than `limit` rows is an error; ordered_pieces() has none."""
    own = listed(df.withColumn("_value", F.col(value)), keys, order, ["_value"], limit)
    return own.select(*keys, F.array_join("rows._value", separator).alias("listed"))


def ordered_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, separator: str = ", ", most: int = 1000) -> DataFrame:
    """Each key's values as texts of `most` values at most, in order: piece (from 0) and listed."""
    own = pieces(df.withColumn("_value", F.col(value)), keys, order, ["_value"], most)
    return own.select(*keys, "piece", F.array_join("rows._value", separator).alias("listed"))


def assemble(entities: DataFrame, columns: DataFrame, rules: DataFrame, entity: str = "entity_id") -> DataFrame:
    """entities with their columns (by ordinal) and rules (by name) as arrays; one pass each."""
    cols = listed(columns, [entity], ["ordinal", "name"], ["ordinal", "name"]).withColumnRenamed("rows", "columns")
    rule = listed(rules.where("rule_name is not null"), [entity], ["rule_name"], ["rule_name"])
    return entities.join(cols, entity, "left").join(rule.select(entity, F.col("rows.rule_name").alias("rules")), entity, "left")


def active_entities(entities: DataFrame, ids: Sequence[int] = (), groups: Sequence[str] = (), entity: str = "entity_id", group: str = "load_group", active: str = "is_active") -> DataFrame:
    """Active rows of the ids and groups asked for (all if none); ValueError on unknown ids."""
    out = entities.where(F.col(active))
    if groups:
        out = out.where(F.col(group).isin(*groups))
    if ids:
        out = out.where(F.col(entity).isin(*ids))
        found = {r[0] for r in out.select(entity).distinct().limit(len(set(ids)) + 1).collect()}
        if unknown := sorted(set(ids) - found):
            raise ValueError(f"unknown or inactive entities: {unknown}")
    return out


def work_items(extracted: DataFrame, entities: DataFrame, entity: str, priority: str) -> DataFrame:
    """Extracted entities that are active, by priority, then id."""
    return extracted.join(entities.select(entity, priority), entity).orderBy(priority, entity)
