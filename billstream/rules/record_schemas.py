"""What each record type has to hold, as JSON Schema."""

STRING, TEXT_OR_NULL, OPEN = {"type": "string"}, {"type": ["string", "null"]}, {"type": "object", "additionalProperties": True}
STRINGS, OBJECTS = {"type": "array", "items": STRING}, {"type": "array", "items": OPEN}
DATE, DATE_TIME, URI = ({"type": "string", "format": f} for f in ("date", "date-time", "uri"))


def closed(properties: dict, optional: tuple = ()) -> dict:
    """An object of just these properties, all required but the optional ones."""
    required = [name for name in properties if name not in optional]
    return {"type": "object", "properties": properties, "required": required, "additionalProperties": False}


OPTION = {"type": "string", "enum": ["yes", "no", "abstain", "absent", "excused", "other"]}
VOTE = closed({"option": OPTION, "voter_name": STRING, "voter_id": STRING, "note": STRING})
VOTE_COUNT = closed({"option": OPTION, "value": {"type": "integer", "minimum": 0}})
SOURCE = closed({"url": URI, "note": STRING}, optional=("note",))
VOTE_FIELDS = {
    "identifier": STRING,
    "motion_text": STRING,
    "motion_classification": STRINGS,
    "start_date": DATE_TIME,
    "result": {"type": "string", "enum": ["pass", "fail", "tie", "other"]},
    "organization": TEXT_OR_NULL,
    "legislative_session": STRING,
    "bill": STRING,
    "bill_action": TEXT_OR_NULL,
    "bill_identifier": STRING,
    "votes": {"type": "array", "items": VOTE},
    "counts": {"type": "array", "items": VOTE_COUNT},
    "sources": {"type": "array", "items": SOURCE},
    "extras": OPEN,
}
ACTION = closed(
    {"description": STRING, "date": DATE_TIME, "organization_id": STRING, "classification": STRINGS, "related_entities": OBJECTS}
)
SESSION = closed(
    {
        "_scraped_name": STRING,
        "classification": {"type": "string", "enum": ["primary", "special"]},
        "identifier": STRING,
        "name": STRING,
        "start_date": DATE,
        "end_date": DATE,
        "active": {"type": "boolean"},
    },
    optional=("active",),
)
BILL_FIELDS = {
    "legislative_session": STRING,
    "identifier": STRING,
    "title": STRING,
    "from_organization": TEXT_OR_NULL,
    "classification": STRINGS,
    "subject": STRINGS,
    "abstracts": OBJECTS,
    "other_titles": OBJECTS,
    "other_identifiers": STRINGS,
    "actions": OBJECTS,
    "sponsorships": OBJECTS,
    "related_bills": OBJECTS,
    "versions": OBJECTS,
    "documents": OBJECTS,
    "citations": OBJECTS,
    "sources": OBJECTS,
    "extras": {"type": "object", "properties": {"wy_enrolled_number": STRING, "chapter": STRING, "effective_date": DATE, "wy_bill_id": {"type": "integer"}}},
    "jurisdiction": OPEN,
    "scraped_at": DATE_TIME,
    "_id": STRING,
}
BILL_REQUIRED = ("legislative_session", "identifier", "title", "classification", "jurisdiction", "scraped_at", "_id")

SCHEMAS = {
    "bill": closed(BILL_FIELDS, optional=tuple(n for n in BILL_FIELDS if n not in BILL_REQUIRED)),
    "vote_event": closed({**VOTE_FIELDS, "_id": STRING}, optional=("identifier", "motion_classification", "bill_action")),
    "organization": closed(
        {
            "_id": STRING,
            "name": STRING,
            "classification": {"type": "string", "enum": ["legislature", "upper", "lower", "committee", "subcommittee", "party", "office"]},
            "parent_id": TEXT_OR_NULL,
            "links": OBJECTS,
            "sources": OBJECTS,
            "extras": OPEN,
        }
    ),
    "jurisdiction": closed(
        {
            "_id": STRING,
            "id": STRING,
            "name": STRING,
            "url": URI,
            "division_id": STRING,
            "classification": {"type": "string", "enum": ["state", "municipality", "county", "federal"]},
            "legislative_sessions": {"type": "array", "items": SESSION},
            "extras": OPEN,
        },
        optional=("url",),
    ),
    "action_log": closed({"action": ACTION, "bill_id": STRING}),
    "vote_log": closed({**VOTE_FIELDS, "organization": STRING}),
}
