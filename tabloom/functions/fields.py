"""Extraction of document fields with several strategies, as column functions.

Each strategy is a struct of nullable strings; the merge takes the first
non-empty value per field. Rows never leave the JVM and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import fixed_values as fv
from tabloom.functions.text import ascii_text, capture, numeric_text
from tabloom.functions.values import coordinates

WELL_FIELDS = [
    "api_number", "well_name", "operator", "county", "field_name", "section", "township", "range_val",
]
TREATMENT_FIELDS = [
    "formation", "treatment_type", "stimulation_stages", "volume", "volume_units", "lbs_proppant",
    "max_treatment_pressure", "max_treatment_rate", "top_ft", "bottom_ft",
]


def _trimmed(value: Column) -> Column:
    return F.nullif(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""), F.lit(""))


def _first_of(text: Column, patterns: list[str]) -> Column:
    return F.coalesce(*(capture(text, p) for p in patterns))


def from_incident_report(text: Column) -> dict[str, Column]:
    """``key: value`` lines."""
    name = _trimmed(capture(text, fv.REPORT_NAME))
    county = _trimmed(capture(text, fv.REPORT_COUNTY))
    return {
        "operator": _trimmed(capture(text, fv.REPORT_OPERATOR)),
        "well_name": F.when(name.rlike(r"(?U)\d") & (F.length(name) < 80), name),
        "file_number": capture(text, fv.REPORT_FILE_NUMBER),
        "field_name": _trimmed(capture(text, fv.REPORT_FIELD)),
        "county": F.when(F.lower(county).isin(fv.COUNTIES), county),
        "section": capture(text, fv.REPORT_SECTION),
        "township": capture(text, fv.REPORT_TOWNSHIP),
        "range_val": capture(text, fv.REPORT_RANGE),
    }


def from_survey(text: Column) -> dict[str, Column]:
    """API number, labelled or bare."""
    labelled = F.replace(capture(text, fv.SURVEY_API), F.lit(" "), F.lit("-"))
    return {"api_number": F.coalesce(labelled, capture(text, fv.SURVEY_API_BARE))}


def from_completion_form(text: Column) -> dict[str, Column]:
    """Values below their labels, section-township-range and county mentions."""
    operators = F.transform(F.regexp_extract_all(text, F.lit(fv.FORM_OPERATOR), F.lit(1)), _trimmed)
    companies = F.filter(
        operators, lambda v: F.lower(v).rlike("|".join(fv.COMPANY_WORDS)) & (F.length(v) < 100)
    )
    county_pattern = fv.FORM_COUNTY.format(names="|".join(fv.COUNTIES))
    county = F.coalesce(capture(text, county_pattern, 1), capture(text, county_pattern, 2))
    field = _trimmed(capture(text, fv.FORM_FIELD))
    place = {
        column: F.coalesce(capture(text, fv.FORM_QUARTERS, g), capture(text, fv.FORM_DASHED, g))
        for g, column in enumerate(["section", "township", "range_val"], start=1)
    }
    return {
        "well_name": _trimmed(capture(text, fv.FORM_NAME)),
        "operator": F.get(companies, F.lit(0)),
        "county": F.initcap(F.lower(county)),
        "field_name": F.when(
            (F.length(field) > 1) & ~F.lower(field).isin(fv.NOT_A_FIELD_ON_FORM), field
        ),
        **place,
    }


def from_verbal_approval(text: Column) -> dict[str, Column]:
    """Labels on one line, values on the next."""
    field = _trimmed(capture(text, fv.APPROVAL_FIELD))
    return {
        "well_name": _trimmed(capture(text, fv.APPROVAL_NAME)),
        "operator": _trimmed(capture(text, fv.APPROVAL_OPERATOR)),
        "field_name": F.when(~F.lower(field).isin(fv.NOT_A_FIELD_ON_APPROVAL), field),
    }


def document_id(filename: Column) -> Column:
    """Digits after the ``W`` of a file name."""
    return capture(filename, fv.NAME_FILE_NUMBER)


def well_fields(text: Column, filename: Column) -> dict[str, Column]:
    """All well columns; the file name's number beats the text's."""
    strategies = [
        from_incident_report(text), from_survey(text), from_completion_form(text), from_verbal_approval(text),
    ]
    merged = {
        field: F.coalesce(*(s[field] for s in strategies if field in s)) for field in WELL_FIELDS
    }
    place = coordinates(text)
    return {
        "file_number": F.coalesce(document_id(filename), strategies[0]["file_number"]),
        **merged,
        "latitude": place["latitude"],
        "longitude": place["longitude"],
    }


def treatment_fields(section: Column) -> dict[str, Column]:
    """The ten treatment values of a treatment section (text may be empty)."""
    formation = F.coalesce(
        *(F.when(section.rlike(rf"(?iudU)\b{name}\b"), F.initcap(F.lit(name))) for name in fv.FORMATIONS),
        _trimmed(capture(section, fv.TREATMENT_FORMATION)),
    )
    comma, none = F.lit(","), F.lit("")
    return {
        "formation": formation,
        "treatment_type": _trimmed(capture(section, fv.TREATMENT_TYPE, 0)),
        "stimulation_stages": capture(section, fv.TREATMENT_STAGES),
        "volume": capture(section, fv.TREATMENT_VOLUME),
        "volume_units": F.initcap(capture(section, fv.TREATMENT_UNITS)),
        "lbs_proppant": F.replace(_first_of(section, fv.TREATMENT_PROPPANT), comma, none),
        "max_treatment_pressure": F.replace(_first_of(section, fv.TREATMENT_PRESSURE), comma, none),
        "max_treatment_rate": F.replace(capture(section, fv.TREATMENT_RATE), comma, none),
        "top_ft": capture(section, fv.TREATMENT_DEPTHS, 1),
        "bottom_ft": capture(section, fv.TREATMENT_DEPTHS, 2),
    }


def extract_wells(documents: DataFrame, text: str = "text", filename: str = "filename") -> DataFrame:
    """One row of well columns per document, other columns kept."""
    found = well_fields(F.col(text), F.col(filename))
    return documents.withColumns({**found, "text_length": F.length(text)})


def extract_treatments(documents: DataFrame, text: str = "text") -> DataFrame:
    """Treatment columns of the documents that name a formation."""
    section = F.regexp_extract(F.col(text), fv.TREATMENT_SECTION, 0)
    with_section = documents.withColumn("_section", section)
    return (
        with_section.withColumns(treatment_fields(F.col("_section")))
        .where(F.col("formation").isNotNull())
        .drop("_section")
    )


def extract_documents(documents: DataFrame, text: str = "text", filename: str = "filename") -> DataFrame:
    """Well and treatment columns side by side, from one pass over the texts.

    ``formation`` is NULL where a document has no treatment record.
    """
    section = F.regexp_extract(F.col(text), fv.TREATMENT_SECTION, 0)
    both = extract_wells(documents, text, filename).withColumn("_section", section)
    return both.withColumns(treatment_fields(F.col("_section"))).drop("_section")


def clean_wells(wells: DataFrame, text_columns: list[str]) -> DataFrame:
    """Readable text columns and zero for missing coordinates."""
    cleaned = {c: ascii_text(F.col(c)) for c in text_columns if c in wells.columns}
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("latitude", "longitude") if c in wells.columns}
    return wells.withColumns({**cleaned, **zero})


def clean_treatments(treatments: DataFrame) -> DataFrame:
    """Readable text and comma-free numbers in the treatment columns."""
    words = ["formation", "treatment_type", "volume_units"]
    return treatments.withColumns(
        {c: ascii_text(F.col(c)) if c in words else numeric_text(F.col(c)) for c in TREATMENT_FIELDS}
    )
