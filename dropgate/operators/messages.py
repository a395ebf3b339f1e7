"""Text of the findings, in one place.

``%d`` / ``%s`` slots are filled per row by ``format_string`` on the Spark
side; ``{name}`` slots are filled on the driver from the registry.
"""

MESSAGES = {
    "always_false": "rule is set to always fail",
    "empty": "no data rows",
    "missing_columns": "required columns absent: ",
    "extra_columns": "columns outside the allowed list: ",
    "column_absent": "column '{col}' is not in this file",
    "below_min": "{col}: %d value(s) below {bound}",
    "above_max": "{col}: %d value(s) above {bound}",
    "nulls": "{col}: %d null or placeholder value(s)",
    "not_type": "{col}: %d value(s) do not parse as {typ}",
    "malformed": "%d row(s) with the wrong number of fields (%d values read in %s)",
    "malformed_at": "; the first is record %d, at byte %d",
    "hierarchy_count": "%d combination(s) with more than one higher level",
    "hierarchy": "%d distinct higher-level values for %s",
    "table_missing": "reference table '{table}' not found",
    "table_column_missing": "reference table has no column '{col}'",
    "missing_id": "id '%s' is not in the reference table",
    "missing_ids": "%d id value(s) not in the reference table",
    "bad_key_params": "key columns must be a list or {key_columns: [...]}",
    "no_keys": "no key columns given",
    "keys_absent_here": "key columns absent here: {cols}",
    "keys_absent_there": "key columns absent in the reference table: {cols}",
    "no_key_matches": "none of the key combinations exists in the reference table",
    "some_key_misses": "%d key combination(s) missing from the reference table",
    "duplicates": "%d row(s) in duplicated groups of {cols}",
    "enrich_unmatched": "{table}: %d of %d row(s) without a match (%d with empty {first})",
    "enrich_ok": "{table}: every row matched",
    "snapshot": "{table}: %d id(s) added, %d known in all",
    "need_columns": "needs column(s) that the data lacks: {cols}",
    "need_numbers": "works on numbers only, but got {cols}",
    "one_case": "choose upper or lower case, not both",
    "no_case": "choose upper or lower case",
    "no_table": "reference table '{table}' does not exist",
    "transform_failed": "transform '{name}' failed: {err}",
    "not_landed": "only {n} of the {all} records counted in the file were landed",
    "not_cleared": "the input stays: fewer rows were delivered than came in",
    "no_pattern": "no registry pattern matches ",
    "many_patterns": "several registry patterns match ",
}


def msg(key: str, **values) -> str:
    text = MESSAGES[key]
    return text.format(**values) if values else text
