"""Rules that mark an action as routine, by locale.

A rule holds if all of its parts hold. Further rules come in as a table (see
``operators.routine.load_rules``).
"""

from __future__ import annotations


def eq(text: str) -> dict:
    return {"equals": text}


def pre(text: str, *contains: str, shorter_than: int | None = None) -> dict:
    return {"prefix": text, "contains": list(contains), "shorter_than": shorter_than}


def has(*contains: str) -> dict:
    return {"contains": list(contains)}


# Classifications dropped per locale.
DENIED_CLASSES = {
    "ak": ["filing", "referral-committee"],
    "al": ["filing"],
    "ar": ["introduction"],
    "ca": ["referral-committee"],
    "co": ["introduction", "referral-committee"],
    "de": ["introduction", "referral-committee"],
    "fl": ["filing"],
    "ga": ["introduction"],
    "hi": ["introduction", "reading-1"],
    "ia": ["introduction", "referral-committee"],
    "id": ["introduction"],
    "il": ["filing"],
    "in": ["reading-1", "referral-committee"],
    "ks": ["introduction", "referral-committee"],
    "ky": ["introduction", "referral-committee"],
    "la": ["filing", "referral-committee"],
    "ma": ["referral-committee"],
    "md": ["introduction", "referral-committee"],
    "me": ["referral-committee"],
    "mi": ["introduction", "referral-committee"],
    "mn": ["introduction", "referral-committee"],
    "mp": ["introduction", "reading-1", "reading-2"],
    "ms": ["referral-committee"],
    "nc": ["referral-committee", "reading-1"],
    "nd": ["introduction"],
    "ne": ["filing", "referral-committee"],
    "nh": ["introduction", "referral-committee"],
    "nj": ["introduction", "referral-committee"],
    "nm": ["referral-committee"],
    "ny": ["referral-committee"],
    "oh": ["introduction", "referral-committee"],
    "ok": ["introduction", "reading-1", "reading-2", "referral-committee"],
    "or": ["introduction", "reading-1", "referral-committee"],
    "pa": ["referral-committee", "reading-1"],
    "pr": ["introduction", "referral-committee"],
    "ri": ["introduction", "referral-committee"],
    "sc": ["introduction", "reading-1", "filing", "referral-committee"],
    "sd": ["introduction", "reading-1", "referral-committee"],
    "tn": ["filing", "introduction"],
    "vt": ["introduction"],
    "wa": ["reading-1", "reading-2", "referral-committee"],
    "wi": ["introduction", "reading-1", "referral-committee"],
    "wv": ["filing", "introduction"],
    "wy": ["introduction", "referral-committee"],
}

# Phrases dropped per locale.
DENIED_PHRASES = {
    "ak": [
        pre("(H) ", ",", shorter_than=20),
        pre("(S) ", ",", shorter_than=20),
        has("Minutes"),
        has("Heard & Held"),
        eq("READ THE FIRST TIME - REFERRALS"),
        pre("FN", ": ZERO"),
        pre("NR:"),
        has("Prefile released"),
    ],
    "al": [
        pre("Read for the first time and referred to"),
        pre("Pending Committee Action in House of Origin"),
        eq("Filed"),
    ],
    "ar": [
        eq("Filed"),
        has("Read first time", "rules suspended", "referred to"),
        has("Read the first time", "rules suspended", "read the second time"),
        eq("Placed on second reading for the purpose of amendment."),
        eq("Rules suspended."),
        eq("REPORTED CORRECTLY ENGROSSED"),
    ],
    "ca": [
        pre("Referred to Com. on"),
        eq("Introduced."),
        eq("Read second time. Ordered to third reading."),
        pre("Set for hearing"),
        pre("June ", "set for first hearing"),
        pre("From printer. May be heard in committee"),
    ],
    "co": [
        pre("Introduced In House - Assigned to"),
        pre("Introduced In Senate - Assigned to"),
        has("Refer Amended to"),
        has("Refer to"),
    ],
    "de": [
        pre("Introduced and Assigned to"),
        pre("Assigned to", "Committee"),
        eq("Not Worked in Committee"),
    ],
    "fl": [
        eq("Filed"),
        pre("Referred to"),
        pre("Now in"),
        pre("On Committee agenda"),
        has("Added to", "agenda"),
    ],
    "ga": [
        eq("Senate Hopper"),
        eq("House Hopper"),
        eq("House First Readers"),
        eq("Senate Read and Referred"),
        eq("House Second Readers"),
        eq("Senate Read Second Time"),
    ],
    "hi": [
        eq("Introduced and Pass First Reading."),
        eq("Introduced and passed First Reading."),
        eq("Report filed."),
        pre("Referred to"),
        has("has scheduled a public hearing"),
        has("Notice of", "hearing"),
    ],
    "ia": [
        pre("Introduced, referred to"),
        eq("Introduced, placed on calendar."),
        pre("Subcommittee:"),
        pre("Subcommittee Meeting:"),
        eq("Read first time, passed on file."),
        eq("Subcommittee recommends passage."),
    ],
    "id": [
        pre("Introduced, read first time"),
        eq("Read second time; Filed for Third Reading"),
        has("U.C. to hold place on third reading calendar"),
        pre("Reported Printed; referred to"),
        eq("Reported out as amended; filed for first reading"),
        eq("Amendments reported printed"),
    ],
    "il": [
        pre("Added Co-Sponsor"),
        pre("Added Alternate Co-Sponsor"),
        eq("Referred to Rules Committee"),
        pre("Filed with Secretary by"),
        pre("Filed with the Clerk by"),
        eq("Referred to Assignments"),
        pre("Rule 2-10"),
        pre("Sponsor Removed"),
    ],
    "in": [
        pre("First reading: referred to"),
        pre("Authored by"),
        pre("Coauthored by"),
        pre("House sponsor:"),
        pre("Cosponsor:"),
    ],
    "ks": [
        eq("Introduced"),
        eq("Received and Introduced"),
        pre("Referred to Committee on"),
        pre("Hearing:"),
        eq("Committee of the Whole - Now working on"),
        eq("Referred to Committee of the Whole"),
    ],
    "ky": [
        eq("introduced in House"),
        eq("introduced in Senate"),
        pre("to ", "("),
        eq("received in House"),
        eq("received in Senate"),
        eq("2nd reading, to Rules"),
        pre("returned to"),
        has("posted for passage in the Consent Orders"),
    ],
    "la": [
        pre("Prefiled and under the rules provisionally referred to"),
        pre("Read by title, rules suspended, referred to"),
        eq("Read by title, ordered engrossed, passed to 3rd reading."),
        eq("Read by title, rules suspended, passed to 3rd reading."),
        eq("Read by title, passed to 3rd reading."),
        pre("Scheduled for floor debate on"),
        eq("Reported without Legislative Bureau amendments."),
    ],
    "ma": [
        pre("Hearing scheduled for"),
        pre("Hearing rescheduled to"),
        eq("Senate concurred"),
        eq("House concurred"),
        pre("Referred to the committee on"),
        pre("Reporting date extended to"),
        pre("Accompanied a"),
    ],
    "md": [
        eq("Pre-filed"),
        pre("First Reading"),
        pre("Hearing "),
        pre("Referred "),
    ],
    "me": [
        pre("The Bill was REFERRED to"),
        pre("Author added"),
        pre("Authors added"),
        eq("Reports READ."),
        eq("Reports Read"),
        eq("Ordered sent down forthwith."),
        eq("Voted - ONTP"),
    ],
    "mi": [
        pre("referred to Committee on"),
        pre("REFERRED TO COMMITTEE"),
        eq("read a first time"),
        pre("INTRODUCED BY"),
        pre("introduced by"),
        pre("bill electronically reproduced"),
        pre("re-referred to Committee on"),
    ],
    "mn": [
        eq("Introduction and first reading"),
        pre("Introduction and first reading, referred to"),
        pre("Referred to"),
        pre("Author added"),
        pre("Authors added"),
    ],
    "mo": [
        eq("Prefiled"),
        eq("Prefiled (H)"),
    ],
    "mp": [
        eq("Date Introduced"),
        eq("House First Reading"),
        eq("House Final Reading"),
        eq("Senate First Reading"),
        eq("Senate Final Reading"),
    ],
    "ms": [
        pre("Referred To"),
        eq("Enrolled Bill Signed"),
        eq("Immediate Release"),
        eq("Motion to Reconsider Tabled"),
    ],
    "mt": [
        pre("(H) Hearing -"),
        pre("(S) Hearing -"),
        has("Scheduled for 2nd Reading"),
        eq("(LC) Draft Ready for Delivery"),
        eq("(LC) Drafter Assigned"),
        eq("(LC) Draft On Hold"),
        eq("(LC) Draft Died in Process"),
        pre("(H) Rereferred to Committee -"),
    ],
    "nc": [
        pre("Ref to the Com on"),
        pre("Re-ref to"),
        pre("Re-ref Com On"),
        pre("Ref To Com On"),
        eq("Passed 1st Reading"),
        eq("Passed 2nd Reading"),
        eq("Filed"),
        eq("Withdrawn From Com"),
        eq("Ordered Enrolled"),
        eq("Reptd Fav"),
    ],
    "nd": [
        pre("Introduced, first reading, referred"),
        pre("Committee Hearing"),
        pre("Reported back, do pass"),
        eq("Received from Senate"),
        eq("Signed by President"),
        eq("Signed by Speaker"),
    ],
    "ne": [
        pre("Referred to"),
        pre("Notice of hearing for"),
        eq("Placed on Select File"),
        eq("Motion to suspend rules to indefinitely postpone filed"),
        eq("Date of introduction"),
        pre("Advanced to Enrollment and Review"),
        pre("Placed on General File with"),
        has("pending", "FA"),
    ],
    "nh": [
        has("Introduced", "referred to"),
        pre("Public Hearing:"),
        pre("Executive Session:"),
        pre("Full Committee Work Session:"),
    ],
    "nj": [
        pre("Introduced in the Assembly, Referred to"),
        pre("Introduced in the Senate, Referred to"),
        pre("Referred to"),
        pre("Reported and Referred to"),
        pre("Transferred to"),
        pre("Substituted for"),
    ],
    "nm": [
        has("DO PASS", "committee report adopted"),
        pre("Sent to ", "Committee"),
    ],
    "nv": [
        pre("Prefiled.", "Referred to Committee"),
        has("Taken from General File", "Placed on General File"),
        pre("From committee: Do pass"),
        has("Placed on Second Reading File"),
    ],
    "ny": [
        pre("REFERRED TO"),
        eq("REPORTED REFERRED TO RULES"),
        eq("INTRODUCED"),
        eq("DELIVERED TO ASSEMBLY"),
        pre("AMEND AND RECOMMIT TO"),
        pre("1ST REPORT CAL"),
        eq("REPORTED TO CALENDAR FOR CONSIDERATION"),
    ],
    "oh": [
        eq("Introduced"),
        pre("Referred to committee"),
        eq("Reported"),
        eq("Reported - Substitute"),
        eq("Informally passed"),
    ],
    "ok": [
        eq("First Reading"),
        pre("Second Reading referred to"),
        pre("Referred to"),
        pre("Authored by"),
        pre("Coauthored by"),
        eq("Referred for enrollment"),
        eq("Referred for engrossment"),
        eq("Withdrawn from Rules Committee"),
    ],
    "or": [
        pre("First reading. Referred to"),
        pre("Referred to"),
        pre("Carried over to"),
        has("Taken from", "Calendar and placed on"),
        eq("Work Session held"),
        eq("Public Hearing and Work Session held"),
        pre("Vote explanation(s) filed by"),
    ],
    "pa": [
        pre("Referred to"),
        eq("First consideration"),
        eq("Laid on the table"),
        eq("Reported as committed"),
    ],
    "pr": [
        eq("Radicado"),
        eq("Referido a Comisión(es)"),
        pre("Remitido a Comisión"),
        eq("En el Calendario de Ordenes Especiales del Senado"),
        pre("Reunión Ejecutiva:"),
        pre("Devuelto a la Comisión(es)"),
    ],
    "ri": [
        pre("Introduced, referred to"),
        pre("Placed on House Calendar"),
        pre("Placed on Senate Calendar"),
        pre("Scheduled for hearing and/or consideration"),
        pre("Scheduled for consideration"),
        eq("Proposed Substitute"),
    ],
    "sc": [
        eq("Prefiled"),
        eq("Introduced and read first time"),
        pre("Referred to Committee on"),
        eq("Read second time"),
        pre("Member(s) request name added as sponsor"),
        eq("Scrivener's error corrected"),
    ],
    "sd": [
        pre("First read in Senate and referred to"),
        pre("First Reading House"),
        has("Select Committee on", "Do Pass"),
        pre("Delivered to the Governor"),
    ],
    "tn": [
        eq("Filed for introduction"),
        eq("Introduced, Passed on First Consideration"),
        pre("Placed on Senate Regular Calendar"),
        pre("Placed on Senate Judiciary Committee calendar"),
        pre("Placed on cal. Calendar & Rules Committee"),
        pre("Rec. for pass"),
        pre("Recommended for passage"),
        eq("Sponsor(s) Added."),
        pre("Engrossed; ready for transmission"),
    ],
    "ut": [
        eq("House/ 1st reading (Introduced)"),
        eq("Senate/ 1st reading (Introduced)"),
        eq("House/ 2nd reading"),
        pre("Senate/ 2nd & 3rd readings/ suspension"),
        pre("House/ passed 2nd & 3rd readings/ suspension"),
        eq("Senate/ to House"),
        eq("House/ to Senate"),
        eq("House/ received from Senate"),
        eq("Senate/ received from House"),
        eq("House/ Rules to 3rd Reading Calendar"),
        eq("House/ enrolled bill to Printing"),
        eq("Senate/ enrolled bill to Printing"),
        eq("Senate/ received bill from Legislative Printing"),
        eq("Bill Numbered but not Distributed"),
        eq("Numbered Bill Publicly Distributed"),
    ],
    "vi": [
        eq("received"),
        eq("Assigned"),
        eq("To Senate"),
    ],
    "vt": [
        pre("Read 1st time & referred to"),
        pre("Read first time and referred to"),
        pre("Referred to Committee on"),
        pre("Referred to Committee on Appropriations per Senate Rule"),
        pre("Referred to Committee on Rules per"),
        eq("Entered on Notice Calendar"),
        eq("On Consent Calendar"),
        eq("Adopted pursuant to Joint Rule 16b"),
        eq("Adopted in concurrence per Joint Rule 16b"),
        eq("Committee Bill for Second Reading"),
    ],
    "wa": [
        pre("First reading, referred to"),
        pre("Referred to"),
        pre("Rules Committee relieved of further consideration.  Placed on second reading"),
        eq("Passed to Rules Committee for second reading"),
        pre("Public hearing in the"),
        pre("Executive session scheduled, but no action was taken"),
        pre("Rules suspended.  Placed on Third Reading"),
    ],
    "wi": [
        pre("Read first time and referred to"),
        has("added as a coauthor"),
        has("added as a cosponsor"),
        pre("Assembly Amendment", "offered by"),
        pre("Senate Amendment", "offered by"),
        eq("Received from Assembly"),
        eq("Received from Senate"),
        eq("Public hearing held"),
        eq("Executive action taken"),
        eq("Fiscal estimate received"),
        pre("Placed on calendar"),
        pre("Withdrawn from committee on Rules and referred to calendar"),
        eq("Ordered immediately messaged"),
        eq("Rules suspended"),
        eq("Read a second time"),
        eq("Ordered to a third reading"),
    ],
    "wv": [
        eq("Filed for introduction"),
        eq("Introduced in House"),
        eq("Introduced in Senate"),
        pre("To ", "House"),
        pre("To ", "Senate"),
        pre("To ", "Finance"),
        pre("To ", "Judiciary"),
        eq("Read 1st time"),
        eq("Read 2nd time"),
        eq("Read 3rd time"),
        eq("On 2nd reading"),
        eq("Communicated to Senate"),
        eq("Reported do pass"),
        eq("Floor amendment adopted (Voice vote)"),
        eq("Amendment withdrawn (Voice vote)"),
    ],
    "wy": [
        pre("H Introduced and Referred to"),
        pre("S Introduced and Referred to"),
        eq("Bill Number Assigned"),
        eq("H Placed on General File"),
        eq("S Placed on General File"),
        pre("S President Signed"),
        pre("Pursuant to JR"),
    ],
}
