"""Log and bill paths as data."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _extract(path: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def is_log_json(path: Column) -> Column:
    return path.contains("/logs/") & path.endswith(".json")


def is_session_log(path: Column) -> Column:
    """The segments must come in this order: country, state, sessions, logs."""
    return path.endswith(".json") & path.rlike("country:.*?/state:.*?/sessions/.*?/logs/")


def is_vote_log(path: Column) -> Column:
    return path.contains(".vote_event.")


def path_stamp(path: Column) -> Column:
    """Text between ``/logs/`` and the next underscore, taken literally."""
    return _extract(path, "/logs/([^_]+)_")


def path_stamp_strict(path: Column) -> Column:
    return _extract(path, r"/logs/(\d{8}T\d{6}Z)_")


def log_stamp(path: Column) -> Column:
    """Stamp used for sorting: the leading stamp of the file name, whatever follows it."""
    return _extract(path, r"/logs/(\d{8}T\d{6}Z)[_.]")


def country_of(path: Column) -> Column:
    return _extract(path, "country:([^/]+)")


def state_of(path: Column) -> Column:
    return _extract(path, "/state:([^/]+)")


def session_of(path: Column) -> Column:
    return _extract(path, "/sessions/([^/]+)")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root`` with forward slashes."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.regexp_replace(slashed, "^" + re.escape(root.rstrip("/")) + "/+", "")


def build_path(state: Column, session: Column, kind: Column, ident: Column) -> Column:
    return F.concat_ws(
        "/",
        F.lit("country:us"),
        F.concat(F.lit("state:"), F.lower(state)),
        F.lit("sessions"),
        session,
        kind,
        ident,
    )


def bill_folder_id(identifier: Column) -> Column:
    return F.replace(identifier, F.lit(" "), F.lit(""))


def vote_result(path: Column) -> Column:
    """pass, fail or unknown; null where the file is no vote log."""
    raw = F.lower(F.regexp_extract(path, r"\.vote_event\.([^.]+)\.", 1))
    return F.when(
        is_vote_log(path), F.when(raw.isin("pass", "fail"), raw).otherwise(F.lit("unknown"))
    )


def template_pattern(template: str) -> tuple[str, list[str]]:
    """``{a}/b/{c}-{d}.json`` to a regular expression with one group per parameter."""
    names = re.findall(r"\{(\w+)\}", template)
    pieces = re.split(r"\{\w+\}", template)
    return "^" + "([^/]+?)".join(re.escape(p) for p in pieces) + "$", names


def parse_template(path: Column, template: str) -> dict[str, Column]:
    """One column per template parameter, null where the path does not fit."""
    pattern, names = template_pattern(template)
    return {n: _extract(path, pattern, i + 1) for i, n in enumerate(names)}
