"""Registered queries: dimension refresh."""

from __future__ import annotations

from campfin.functions.predicates import LEGACY_COLLATION
from campfin.operators.dims import insert_new, update_dim
from campfin.plans.rawlines import expected_sql, typed
from campfin.plans.registry import register
from campfin.plans.standins import build, previous_dim, previous_fields
from campfin.schemas import CM_ATTRS, CM_FIELDS, CN_ATTRS, CN_FIELDS, D

# All attributes of a dimension take part.  In the previous production dimension
# each of them alone differs in some rows (must update) and is NULL in others
# (must not: NULL != x is unknown); see ``previous_fields``.


def _layout(kind):
    fields = CN_FIELDS if kind == "cn" else CM_FIELDS
    attrs = CN_ATTRS if kind == "cn" else CM_ATTRS
    return f"{kind}_id", attrs, {f[0] for f in fields if f[1] == D}


def _prev_sql(kind):
    key, attrs, numeric = _layout(kind)
    old = ", ".join(f"{e} AS {a}" for a, e in previous_fields(attrs, numeric).items())
    return f""",
now AS ({expected_sql(kind, kind, extra=("id",))}),
staged AS ({expected_sql(kind, "s" + kind)}),
prev AS (SELECT id, y2, {key}, {old} FROM now WHERE id % 4 <> 0)"""


def _update_sql(kind, lower=False):
    key, attrs, numeric = _layout(kind)
    folded = (lambda c, a: f"lower(rtrim({c}))" if lower and a not in numeric else c)
    differs = " OR ".join(f"{folded('p.' + a, a)} <> {folded('s.' + a, a)}" for a in attrs)
    after = ",\n       ".join(f"CASE WHEN upd THEN s_{a} ELSE {a} END AS {a}" for a in attrs)
    both = ", ".join(f"s.{a} AS s_{a}" for a in attrs)
    return _prev_sql(kind) + f""",
j AS (SELECT p.*, coalesce(s.{key} IS NOT NULL AND ({differs}), false) AS upd, {both}
      FROM prev AS p LEFT JOIN staged AS s ON p.y2 = s.y2 AND p.{key} = s.{key})
SELECT id, y2, {key},
       {after},
       upd AS updated
FROM j"""


def _insert_sql(kind):
    key, attrs, _ = _layout(kind)
    return _prev_sql(kind) + f""",
new AS (SELECT s.* FROM staged AS s
        WHERE NOT EXISTS (SELECT 1 FROM prev AS p WHERE p.y2 = s.y2 AND p.{key} = s.{key}))
SELECT (SELECT max(id) FROM prev) + row_number() OVER (ORDER BY y2, {key}) AS id,
       y2, {key}, {", ".join(attrs)}
FROM new"""


def _state(spark, sf_dir, kind):
    s = build(spark, sf_dir)
    dim, staged = (s.cn, s.scn) if kind == "cn" else (s.cm, s.scm)
    key, attrs, numeric = _layout(kind)
    return previous_dim(typed(dim, kind, extra=("id",)), attrs, numeric), typed(staged, kind), key, attrs


def _update(kind, collation=None):
    def run(spark, sf_dir):
        prev, staged, key, attrs = _state(spark, sf_dir, kind)
        u = update_dim(prev, staged, key, attrs, collation=collation)
        return u.select("id", "y2", key, *attrs, "updated")
    return run


def _insert(kind):
    def run(spark, sf_dir):
        prev, staged, key, attrs = _state(spark, sf_dir, kind)
        return insert_new(prev, staged, key).select("id", "y2", key, *attrs)
    return run


for _kind in ("cn", "cm"):
    register(f"dim_update_{_kind}", _update_sql(_kind))(_update(_kind))
    register(f"dim_insert_{_kind}", _insert_sql(_kind))(_insert(_kind))
# Change test under the legacy collation: case and trailing spaces are no change.
register("dim_update_cm_legacy", _update_sql("cm", lower=True))(_update("cm", LEGACY_COLLATION))
