"""Prompts for text generation and for checking a note against its codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewright.constants import NOTE_TYPES

#: Sections of each note type; own wording, to be replaced by a caller's.
STRUCTURES = {
    "PROGRESS_NOTE": "Subjective, Objective, Assessment, Plan",
    "H_AND_P": "Chief complaint, History, Medications, Allergies, Examination, Assessment and plan",
    "EMERGENCY_DEPARTMENT_VISIT": "Chief complaint, Triage, History, Examination, Workup, Course, Disposition",
    "DISCHARGE_SUMMARY": "Dates, Admitting diagnosis, Hospital course, Discharge diagnoses, Medications, Follow-up",
    "CONSULTATION_NOTE": "Reason, History, Records, Examination, Findings, Assessment, Recommendations",
    "OPERATIVE_NOTE": "Diagnoses, Procedure, Team, Anesthesia, Findings, Details, Specimens, Blood loss, Complications",
}
TEMPLATE = "Write a realistic {note_type}. Never write a diagnosis code.\n\nDiagnoses:\n{diagnoses}\n\nSections: {structure}\n\nContext: {context}\n"


def diagnosis_lines(codes: Column) -> Column:
    """Numbered lines of an array of codes (name, category_name): ``1. name (Category: ...)``, the category if any."""

    def line(c, i):
        named = F.concat((i + 1).cast("string"), F.lit(". "), c["name"])
        return F.concat(named, F.when(F.coalesce(c["category_name"], F.lit("")) != "", F.concat(F.lit(" (Category: "), c["category_name"], F.lit(")"))).otherwise(""))

    return F.array_join(F.transform(codes, line), "\n")


def generation_prompt(note_type: Column, codes: Column, context: Column, template: str = TEMPLATE, structures: dict[str, str] | None = None) -> Column:
    """The prompt: the type in title case, the diagnoses, the type's structure (a progress note's if unknown), the context or "None"."""
    by_type = F.create_map(*[F.lit(x) for pair in (structures or STRUCTURES).items() for x in pair])
    out = F.lit(template)
    parts = {
        "note_type": F.initcap(F.replace(F.lower(note_type), F.lit("_"), F.lit(" "))),
        "diagnoses": diagnosis_lines(codes),
        "structure": F.coalesce(by_type[note_type], by_type[F.lit(NOTE_TYPES[0])]),
        "context": F.when(F.coalesce(context, F.lit("")) == "", "None").otherwise(context),
    }
    for name, value in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def validation_prompt(note: Column, codes: Column) -> Column:
    """A prompt that asks, as JSON, whether a note supports its codes (``- code: name`` lines)."""
    lines = F.array_join(F.transform(codes, lambda c: F.concat(F.lit("- "), c["code"], F.lit(": "), c["name"])), "\n")
    ask = 'Answer in JSON with "is_valid", "confidence_score" (0-100), "critical_issues", "warnings" and "code_analysis".'
    return F.concat(F.lit("Does the note support each code?\n\nNote:\n"), note, F.lit("\n\nCodes:\n"), lines, F.lit("\n\n" + ask))
