"""Contract tests over tables.

Each test returns a one-row DataFrame ``(test_name, failures)``; failures
follow the counting of the SQL test macros: null rows, duplicated values,
duplicated combinations, distinct unaccepted values, orphan child rows,
rows that break the 1-day sequence. ``run_tests`` stacks them; a passing
suite has 0 everywhere. No test sorts a whole column in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.reshape import union_all


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("test_name"),
                     F.coalesce(F.col("failures").cast("long"), F.lit(0)).alias("failures"))


def not_null(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return _named(df.agg(F.count_if(F.col(col).isNull()).alias("failures")),
                  name or f"not_null_{col}")


def unique(df: DataFrame, col: str, where: str | None = None, name: str | None = None) -> DataFrame:
    src = df.filter(where) if where else df
    dup = src.filter(F.col(col).isNotNull()).groupBy(col).count().filter("count > 1")
    return _named(dup.agg(F.count(F.lit(1)).alias("failures")), name or f"unique_{col}")


def unique_combination(df: DataFrame, cols: Sequence[str], name: str | None = None) -> DataFrame:
    dup = df.groupBy(*cols).count().filter("count > 1")
    return _named(dup.agg(F.count(F.lit(1)).alias("failures")),
                  name or "unique_combination_" + "_".join(cols))


def accepted_values(df: DataFrame, col: str, values: Sequence, name: str | None = None) -> DataFrame:
    bad = df.filter(~F.col(col).isin(*values)).select(col).distinct()
    return _named(bad.agg(F.count(F.lit(1)).alias("failures")), name or f"accepted_values_{col}")


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                  name: str | None = None) -> DataFrame:
    # rows per key first: combined before the shuffle, and a hot key joins as one row
    keys = child.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_col).alias("_k")), "_k", "left_anti")
    return _named(orphans.agg(F.sum("_n").alias("failures")),
                  name or f"relationships_{col}_to_{parent_col}")


def sequential_days(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Rows whose predecessor in sort order is not the previous day.

    Without a global sort: a repeated value fails once per extra copy; the
    first copy of a value passes exactly when the previous day is present
    (then it is the greatest smaller value); the minimum has no predecessor.
    """
    vals = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("date").alias("_d")).count()
    prev = vals.select(F.date_add("_d", 1).alias("_d"), F.lit(True).alias("_has_prev"))
    marked = vals.join(prev, "_d", "left")
    # the minimum is always among the values without a predecessor: take it off
    fails = marked.agg((F.sum(F.col("count") - 1)
                        + F.count_if(F.col("_has_prev").isNull()) - 1).alias("failures"))
    return _named(fails, name or f"sequential_values_{col}")


def run_tests(tests: Sequence[DataFrame]) -> DataFrame:
    """Stack test results into one (test_name, failures) table (Q12)."""
    return union_all(tests)


def no_overlapping_versions(dim: DataFrame, key: str, valid_from: str, valid_to: str,
                            name: str | None = None) -> DataFrame:
    """Versions overlapping an earlier version of their key (fan-out guard)."""
    from lakeops.operators.pit import overlapping_versions
    bad = overlapping_versions(dim, key, valid_from, valid_to)
    return _named(bad.agg(F.count(F.lit(1)).alias("failures")), name or f"no_overlapping_versions_{key}")


# ---- declarative contracts ---------------------------------------------------
#
# Contracts can be declared in the schema-YAML layout used by SQL projects
# (``models:`` or ``sources: ... tables:``, each with model-level and column-level
# ``data_tests``/``tests``; arguments under ``arguments:`` or inline; a row
# filter under ``config: where:``). ``specs_from_yaml`` turns such text into
# plain specs and ``run_specs`` runs them over named DataFrames.

_KINDS = {"not_null": "not_null", "unique": "unique", "accepted_values": "accepted_values",
          "relationships": "relationships", "dbt_utils.unique_combination_of_columns": "unique_combination",
          "unique_combination_of_columns": "unique_combination", "dbt_utils.sequential_values": "sequential",
          "sequential_values": "sequential"}


def _ref_name(text: str) -> str:
    """ref('x') -> x; source('s', 't') -> t; plain names unchanged."""
    import re
    m = re.match(r"\s*(?:ref|source)\((.*)\)\s*$", text)
    if not m:
        return text.strip()
    return [p.strip().strip("'\"") for p in m.group(1).split(",")][-1]


def _test_entries(node: dict) -> list:
    return list(node.get("data_tests") or []) + list(node.get("tests") or [])


def _spec(model: str, column: str | None, entry) -> dict:
    if isinstance(entry, str):
        name, body = entry, {}
    else:
        (name, body), = entry.items()
        body = body or {}
    if name not in _KINDS:
        raise ValueError(f"unsupported contract test {name!r} on {model}")
    args = dict(body.get("arguments") or {})
    args.update({k: v for k, v in body.items() if k not in ("arguments", "config")})
    where = (body.get("config") or {}).get("where") or args.pop("where", None)
    return {"model": model, "column": column, "kind": _KINDS[name], "args": args, "where": where}


def specs_from_yaml(text: str) -> list[dict]:
    import yaml
    doc = yaml.safe_load(text) or {}
    nodes = list(doc.get("models") or [])
    for src in doc.get("sources") or []:
        nodes += list(src.get("tables") or [])
    specs = []
    for node in nodes:
        model = node["name"]
        specs += [_spec(model, None, e) for e in _test_entries(node)]
        for col in node.get("columns") or []:
            specs += [_spec(model, col["name"], e) for e in _test_entries(col)]
    return specs


def spec(model: str, kind: str, column: str | None = None, name: str | None = None, where: str | None = None, **args) -> dict:
    """A test of ``run_specs``: kind not_null, unique, unique_combination
    (``combination_of_columns``), accepted_values (``values``), relationships
    (``to``, ``field``) or sequential."""
    return {"model": model, "column": column, "kind": kind, "args": args, "where": where, "name": name}


def spec_name(spec: dict) -> str:
    kind, model, col = spec["kind"], spec["model"], spec["column"]
    if spec.get("name"):
        return spec["name"]
    if kind == "unique_combination":
        return f"unique_combination_{model}_" + "_".join(spec["args"]["combination_of_columns"])
    if kind == "relationships":
        return f"relationships_{model}_{col}_to_{_ref_name(spec['args']['to'])}_{spec['args']['field']}"
    return f"{kind}_{model}_{col}"


def _rows(names: Sequence[str], counts: DataFrame) -> DataFrame:
    """One row of counts (columns n0, n1, ...) -> (test_name, failures)."""
    return counts.select(F.inline(F.array(*(F.struct(
        F.lit(name).alias("test_name"), F.coalesce(F.col(f"n{i}").cast("long"), F.lit(0)).alias("failures"))
        for i, name in enumerate(names)))))


def _null_counts(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """All not_null tests of a table in one aggregate."""
    where = [F.expr(s["where"]) if s["where"] else F.lit(True) for s in specs]
    return _rows([spec_name(s) for s in specs], df.agg(*(
        F.count_if(w & F.col(s["column"]).isNull()).alias(f"n{i}") for i, (s, w) in enumerate(zip(specs, where)))))


def _group_counts(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """All tests of a table that look at groups of equal values, from one scan:
    a grouped count over a grouping set per key (columns and row filter)."""
    keys: dict[tuple, list[str]] = {}
    made: dict[str, object] = {}
    for s in specs:
        cols = s["args"]["combination_of_columns"] if s["kind"] == "unique_combination" else [s["column"]]
        key = (tuple(cols), s["where"])
        if key not in keys:
            k = len(keys)
            keep = F.expr(s["where"]) if s["where"] else F.lit(True)
            made |= {f"_k{k}_{j}": F.when(keep, F.col(c)) for j, c in enumerate(cols)} | {f"_k{k}_in": F.coalesce(keep, F.lit(False))}
            keys[key] = [c for c in made if c.startswith(f"_k{k}_")]
        s["_key"] = key
    names = list(made)
    groups = df.select(*(c.alias(n) for n, c in made.items())).groupingSets(list(keys.values()), *names).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_g"))

    def fails(s: dict):
        cols = keys[s["_key"]]
        own = sum(0 if n in cols else 1 << (len(names) - 1 - i) for i, n in enumerate(names))
        here = (F.col("_g") == own) & F.col(cols[-1])
        if s["kind"] == "accepted_values":
            return here & F.col(cols[0]).isNotNull() & ~F.col(cols[0]).isin(*s["args"]["values"])
        twice = here & (F.col("_n") > 1)
        return twice & F.col(cols[0]).isNotNull() if s["kind"] == "unique" else twice
    return _rows([spec_name(s) for s in specs], groups.agg(*(F.count_if(fails(s)).alias(f"n{i}") for i, s in enumerate(specs))))


def run_specs(tables, specs: Sequence[dict]) -> DataFrame:
    """Run declarative specs over ``tables`` (name -> DataFrame): one
    (test_name, failures) row per spec. A table is scanned once for all its null
    counts and once for all its grouped counts, not once per test; a table
    that is a plan of its own should be written (materialized) before."""
    out, by_model = [], {}
    for s in specs:
        by_model.setdefault(s["model"], []).append(dict(s))
    for model, own in by_model.items():
        df = tables[model]
        nulls = [s for s in own if s["kind"] == "not_null"]
        groups = [s for s in own if s["kind"] in ("unique", "unique_combination", "accepted_values")]
        if nulls:
            out.append(_null_counts(df, nulls))
        if groups:
            out.append(_group_counts(df, groups))
        for s in own:
            rows = df.filter(s["where"]) if s["where"] else df
            col, args = s["column"], s["args"]
            if s["kind"] == "relationships":
                out.append(relationships(rows, col, tables[_ref_name(args["to"])], args["field"], spec_name(s)))
            elif s["kind"] == "sequential":
                if str(args.get("datepart", "day")) != "day" or int(args.get("interval", 1)) != 1:
                    raise ValueError("sequential_values: only interval 1, datepart day")
                out.append(sequential_days(rows, col, spec_name(s)))
    return run_tests(out)
