"""Schemas of the scraped record types (open parts as VARIANT)."""

from __future__ import annotations

_LINKS = "ARRAY<STRUCT<url STRING, media_type STRING>>"
_NOTED = f"ARRAY<STRUCT<note STRING, date STRING, links {_LINKS}>>"
_SOURCES = "ARRAY<STRUCT<url STRING, note STRING>>"

ACTION = (
    "STRUCT<description STRING, date STRING, organization_id STRING, classification ARRAY<STRING>, "
    "related_entities ARRAY<STRUCT<name STRING, entity_type STRING>>, "
    "_processing STRUCT<log_file_created STRING>>"
)

BILL = (
    "legislative_session STRING, identifier STRING, title STRING, from_organization STRING, "
    "classification ARRAY<STRING>, subject ARRAY<STRING>, "
    "abstracts ARRAY<STRUCT<abstract STRING, note STRING>>, "
    "other_titles ARRAY<STRUCT<title STRING, note STRING>>, other_identifiers ARRAY<STRING>, "
    f"actions ARRAY<{ACTION}>, "
    "sponsorships ARRAY<STRUCT<name STRING, classification STRING, entity_type STRING, `primary` BOOLEAN, "
    "person_id STRING, organization_id STRING>>, "
    "related_bills ARRAY<STRUCT<legislative_session STRING, identifier STRING, relation_type STRING>>, "
    f"versions {_NOTED}, documents {_NOTED}, citations ARRAY<VARIANT>, sources {_SOURCES}, extras VARIANT, "
    "jurisdiction STRUCT<id STRING, name STRING, classification STRING, division_id STRING>, "
    "scraped_at STRING, _id STRING, "
    "_processing STRUCT<logs_latest_update STRING, text_extraction_latest_update STRING>"
)

VOTE_EVENT = (
    "identifier STRING, motion_text STRING, motion_classification ARRAY<STRING>, start_date STRING, "
    "result STRING, organization STRING, legislative_session STRING, bill STRING, bill_action STRING, "
    "bill_identifier STRING, "
    "votes ARRAY<STRUCT<option STRING, voter_name STRING, voter_id STRING, note STRING>>, "
    f"counts ARRAY<STRUCT<option STRING, value INT>>, sources {_SOURCES}, extras VARIANT, _id STRING"
)

EVENT = (
    "name STRING, description STRING, start_date STRING, end_date STRING, status STRING, "
    "classification STRING, legislative_session STRING, location STRUCT<name STRING, note STRING>, "
    f"media ARRAY<STRUCT<name STRING, type STRING, links {_LINKS}>>, "
    "agenda ARRAY<STRUCT<description STRING, `order` INT, subjects ARRAY<STRING>, "
    "related_entities ARRAY<STRUCT<entity_type STRING, name STRING, entity_id STRING, note STRING>>>>, "
    "participants ARRAY<STRUCT<name STRING, entity_type STRING, note STRING>>"
)

JURISDICTION = (
    "_id STRING, id STRING, name STRING, url STRING, division_id STRING, classification STRING, extras VARIANT, "
    "legislative_sessions ARRAY<STRUCT<_scraped_name STRING, classification STRING, identifier STRING, "
    "name STRING, start_date STRING, end_date STRING, active BOOLEAN>>"
)

ORGANIZATION = (
    "_id STRING, name STRING, classification STRING, parent_id STRING, links ARRAY<VARIANT>, "
    "sources ARRAY<VARIANT>, extras VARIANT"
)

BY_KIND = {
    "bill": BILL,
    "vote_event": VOTE_EVENT,
    "event": EVENT,
    "jurisdiction": JURISDICTION,
    "organization": ORGANIZATION,
}

LOG = "action " + ACTION + ", bill_id STRING"
