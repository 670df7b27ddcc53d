"""Column -> Column helpers. All are built-in Spark expressions (JVM side, codegen friendly)."""

from ratewatch.functions.casting import (  # noqa: F401
    first_truthy, nullif_empty, to_bool_pg, to_numeric, to_timestamptz,
)
from ratewatch.functions.jsonpath import (  # noqa: F401
    json_array, json_member, json_text, parse_json_lenient, json_parse_error,
)
from ratewatch.functions.text import (  # noqa: F401
    clip_text, error_text, fill_template, gate_detail, hours_between, page_label, py_float_text,
    resolve_url, safe_path_component, sha256_hex, url_join,
)
