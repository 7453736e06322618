"""Column functions: flags, URL text, JSON values, outcomes."""

from hubloom.functions.flags import flag_status, strict_bool
from hubloom.functions.json_values import json_value, query_value
from hubloom.functions.outcomes import is_failure, outcome
from hubloom.functions.text import trim_space
from hubloom.functions.urls import (
    canonical_query, command_key, encode_values, first_values, parse_query,
    path_escape, query_escape, query_of, query_pairs, query_values,
)

__all__ = [
    "canonical_query", "command_key", "encode_values", "first_values",
    "flag_status", "is_failure", "json_value", "outcome", "parse_query",
    "path_escape", "query_escape", "query_of", "query_pairs", "query_value",
    "query_values", "strict_bool", "trim_space",
]
