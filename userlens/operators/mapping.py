"""The event -> payload-attribute mapping, from its three metadata relations.

Result: one row per action with ``attrs``, an array of attribute structs
sorted by attribute name. One row per action means the broadcast lookup in
the log job can never multiply fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import compiled_rules

ATTR_FIELDS = ["target_attribute", "datatype", "ps", "es_ps", "plateform"]


def join_mapper_template(mapper: DataFrame, template: DataFrame) -> DataFrame:
    """Mapper rows left-joined to templates; only mapper columns are kept."""
    t = template.select(F.col("id").alias("__tid"))
    j = mapper.join(t, mapper["template_id"] == t["__tid"], "left")
    return j.select("action_id", "template_id")


def one_template_per_action(mapper: DataFrame) -> DataFrame:
    """A later mapper row overwrote an earlier one; the highest id wins (D1)."""
    return mapper.groupBy("action_id").agg(F.max("template_id").alias("template_id"))


def active_details(detail: DataFrame) -> DataFrame:
    """``status = 1`` details, one per (template, attribute): the max wins."""
    d = detail.where(F.col("status") == 1)
    best = F.max(F.struct(*[F.col(c) for c in ATTR_FIELDS]))
    return (d.groupBy("template_id", "attribute").agg(best.alias("__a"))
            .select("template_id", "attribute", *[F.col(f"__a.{c}").alias(c) for c in ATTR_FIELDS]))


def collect_mapping(details: DataFrame) -> DataFrame:
    """Details of a template as one array sorted by attribute."""
    attr = F.struct(F.col("attribute"), *[F.col(c) for c in ATTR_FIELDS])
    return details.groupBy("template_id").agg(F.array_sort(F.collect_list(attr)).alias("attrs"))


def join_template_detail(actions: DataFrame, per_template: DataFrame) -> DataFrame:
    """Each action's attribute array; an action without details gets ``[]``."""
    j = actions.join(per_template, "template_id", "left")
    empty = F.array().cast(per_template.schema["attrs"].dataType)
    return j.select(F.col("action_id").cast("long").alias("action_id"),
                    F.coalesce(F.col("attrs"), empty).alias("attrs"))


def build_event_mapping(mapper: DataFrame, template: DataFrame, detail: DataFrame) -> DataFrame:
    actions = one_template_per_action(join_mapper_template(mapper, template))
    return join_template_detail(actions, collect_mapping(active_details(detail)))


def compile_mapping(mapping: DataFrame) -> DataFrame:
    """``rules`` in place of ``attrs``: what log rows look up, compiled once per action."""
    return mapping.select("action_id", compiled_rules("attrs").alias("rules"))


def flatten_mapping(mapping: DataFrame) -> DataFrame:
    """One row per (action, attribute): the flat, comparable form."""
    return (mapping.select("action_id", F.explode("attrs").alias("a"))
            .select("action_id", "a.attribute", *[F.col(f"a.{c}").alias(c) for c in ATTR_FIELDS]))
