import json

from cohortloom.config import load_settings
from cohortloom.functions.sections import ends_section, label_section

LONG = "is used for the relief of signs and symptoms in adults who had no response to at least one other treatment of this kind. "


def test_sections_by_rules_numbers_and_capitals():
    between = f"x\n-----\nINDICATIONS AND USAGE\n-----\nDrug {LONG}\n-----\nDOSAGE\n-----\nno"
    assert label_section(between) == ("Drug " + LONG).strip()
    underlined = f"INDICATIONS AND USAGE\n=====\nDrug {LONG}\n=====\nno"
    assert label_section(underlined) == ("Drug " + LONG).strip()
    numbered = f"INDICATIONS AND USAGE\n{LONG * 3}\n1 INDICATIONS AND USAGE\nABCDE {LONG}\n1.1 Adults\nmore words\nABCDE IN CAPITALS\n2 DOSAGE\nno"
    assert label_section(numbered) == f"ABCDE {LONG} 1.1 Adults more words ABCDE IN CAPITALS".replace("  ", " ")
    assert label_section(f"Indications and Usage\n{LONG * 2}\nSTORAGE CONDITIONS\nno") == (LONG * 2).strip()
    assert label_section("INDICATIONS AND USAGE\nshort\nCONTRAINDICATIONS\nno") is None
    assert label_section(None) is None and label_section("") is None and label_section("x" * 100_000) is None


def test_headings_that_end_a_section():
    assert ends_section("5.1 Clinical Studies", True, None) and ends_section("12 Other", True, None) and not ends_section("1.2 Other", True, None)
    assert ends_section("STORAGE", False, None) and not ends_section("STORAGE", True, None) and not ends_section("TNF", False, None) and not ends_section("HUMIRA USE", False, "HUMIRA")


def test_settings(tmp_path):
    f = tmp_path / "s.json"
    f.write_text(json.dumps({"max_retries": 5, "export_csv": "yes", "other": 1}))
    s = load_settings(str(f), {"REQUEST_DELAY": "0.5", "MAX_RETRIES": "many", "OUTPUT_DIR": "/x"})
    assert (s.request_delay, s.output_dir, s.unknown) == (0.5, "/x", {"other": 1})
    assert s.errors() == ["invalid value for max_retries: 'many'", "invalid value for export_csv: 'yes'"] and load_settings().errors() == []
