from pyspark.sql import functions as F

from tabloom.functions import fields


def wells(spark, text, name="W123.pdf"):
    return fields.extract_wells(spark.createDataFrame([(name, text)], "filename string, text string")).head()


def treatments(spark, text):
    return fields.extract_treatments(spark.createDataFrame([("W1.pdf", text)], "filename string, text string")).collect()


def test_file_name_number_beats_text(spark):
    assert wells(spark, "NDIC File Number: 77", "W123.pdf")["file_number"] == "123"
    assert wells(spark, "NDIC File No.: 77", "scan.pdf")["file_number"] == "77"
    assert wells(spark, "nothing", "scan.pdf")["file_number"] is None


def test_report_beats_form(spark):
    row = wells(spark, "Well Operator: First Co\nWell Name: ALPHA 1H\nOperator\nSecond Oil Company\nCounty: Dunn\nWard County")
    assert (row["operator"], row["well_name"], row["county"]) == ("First Co", "ALPHA 1H", "Dunn")


def test_report_guards(spark):
    row = wells(spark, "Well Name: NO DIGITS\nCounty: Atlantis\nField Name: Sand Creek 9")
    assert row["well_name"] is None and row["county"] is None and row["field_name"] == "Sand Creek"
    assert wells(spark, "Well Name: " + "x" * 80 + "1")["well_name"] is None


def test_api_number_forms(spark):
    assert wells(spark, "API Number: 33 053 12345")["api_number"] == "33-053-12345"
    assert wells(spark, "see 33-053-12345 there")["api_number"] == "33-053-12345"
    assert wells(spark, "see 33-053-123456 there")["api_number"] is None


def test_form_picks_first_company_and_earliest_county(spark):
    row = wells(spark, "Operator\nJohn Smith\nOperator Telephone 1\n  Hess Corp \nstark county and dunn county\nField\nOIL\n")
    assert row["operator"] == "Hess Corp" and row["county"] == "Stark" and row["field_name"] is None
    assert wells(spark, "County |Golden Valley is it")["county"] == "Golden Valley"


def test_sections_prefer_quarter_lines(spark):
    row = wells(spark, "12-150N-98W and SESE 7 151 N 99 W")
    assert (row["section"], row["township"], row["range_val"]) == ("7", "151", "99")
    row = wells(spark, "at 12-150N-98W")
    assert (row["section"], row["township"], row["range_val"]) == ("12", "150", "98")


def test_all_null_text_and_empty_input(spark):
    row = wells(spark, None)
    assert all(row[c] is None for c in [*fields.WELL_FIELDS, "latitude", "longitude"])
    none = spark.createDataFrame([], "filename string, text string")
    assert fields.extract_wells(none).count() == 0 and fields.extract_treatments(none).count() == 0


def test_no_formation_means_no_record(spark):
    assert treatments(spark, "Well Specific Stimulation Sand Frac 5000 PSI") == []
    assert treatments(spark, "Bakken without the section word") == []


def test_middle_bakken_is_tried_before_bakken(spark):
    (row,) = treatments(spark, "Stimulation in the bakken, later MIDDLE BAKKEN")
    assert row["formation"] == "Middle Bakken" and row["treatment_type"] is None and row["volume"] is None


def test_formation_after_its_label(spark):
    (row,) = treatments(spark, "Date Stimulated Formation: Tyler 10500")
    assert row["formation"] == "Tyler"


def test_section_ends_at_the_next_heading(spark):
    (row,) = treatments(spark, "Stimulated Nisku Acid 2500 Gallons\nDrill Stem Test 9999 PSI")
    assert row["formation"] == "Nisku" and row["treatment_type"] == "Acid"
    assert row["volume"] == "2500" and row["volume_units"] == "Gallons" and row["max_treatment_pressure"] is None


def test_proppant_and_pressure_fallbacks(spark):
    (row,) = treatments(spark, "Stimulated Lodgepole Sand Frac 20.5 % 1,234,567 max 9500 PSI")
    assert row["lbs_proppant"] == "1234567" and row["max_treatment_pressure"] == "9500"
    (row,) = treatments(spark, "Stimulated Lodgepole used 250,000 lbs")
    assert row["lbs_proppant"] == "250000"


def test_depths_and_rate(spark):
    text = "Stimulated Duperow\nTop (Ft) | Bottom (Ft) | Stages\n x 10500 | 20500 \nTreatment Rate (BBLS/Min): 1,070.5"
    (row,) = treatments(spark, text)
    assert (row["top_ft"], row["bottom_ft"], row["max_treatment_rate"]) == ("10500", "20500", "1070.5")


def test_unicode_blanks_count_as_blanks(spark):
    assert wells(spark, "Well Operator : A B\r\nCounty: Dunn")["operator"] == "A B"


def test_cleaning_fills_defaults(spark):
    (row,) = fields.clean_treatments(
        fields.extract_treatments(spark.createDataFrame([("a", "Stimulated Nisku")], "filename string, text string"))
    ).collect()
    assert row["formation"] == "Nisku" and row["treatment_type"] == "N/A" and row["volume"] == "0"
    found = fields.extract_wells(spark.createDataFrame([("a", "x")], "filename string, text string"))
    cleaned = fields.clean_wells(found, ["operator"]).head()
    assert cleaned["operator"] == "N/A" and cleaned["latitude"] == 0
