"""Fixed values as the SQL of the queries has them: typed apart from those under test, so that a changed one shows."""

from __future__ import annotations

# fixed values
ARM_PREFIX = r"^(experimental|active\s+comparator|placebo(\s+comparator)?|arm\s+[a-z0-9]+|group\s+\d+|cohort\s+[a-z\d]+)\s*[:\-–]\s*"
ARM_DOSE = r"\b\d+(\.\d+)?\s*(mg/m2|mg/kg|mg|mcg|g|auc\d+|iu|units)\b"
ARM_FREQUENCY = r"\bq[dwm]\d*|q\d*[dwm]|qod|bid|tid|daily|weekly|monthly|once\b"
FORM_WORDS = r"\s+(tablet|capsule|injection|solution|oral|topical|cream|ointment)s?$"
DOSE = r"\s+\d+\s*(mg|mcg|g|ml|%)"
INTERVENTION_PREFIX = r"^(drug|biological|other|procedure|device|radiation|diagnostic\s+test|dietary\s+supplement|behavioral|combination\s+product|genetic)\s*:\s*"
ALIAS_NOISE = (
    r"\b\d+(\.\d+)?\s*(ml|mg|mcg|unt|iu|kg|g|%)\b|\b(auto-injector|prefilled syringe|injection|tablet|capsule|extended release|oral solution"
    r"|oral suspension|inhalation|patch|gel|cream|ointment|syrup|drops|lozenge|film|strip|powder)\b"
)
SALTS = (
    r"(\s+(mesylate|dimaleate|hydrochloride|phosphate|disodium|sodium|tartrate|hydrate|dimethyl\s+sulfoxide|sulfoxide|acetate|citrate|fumarate|maleate"
    r"|tosylate|besylate|succinate|sulfate|nitrate|bromide|chloride|gluconate|albumin-stabilized\s+nanoparticle\s+formulation))+\s*$"
)
AE_CODES = {
    "nausea": "10027159",
    "vomiting": "10042365",
    "diarrhea": "10017916",
    "diarrhoea": "10017916",
    "rash": "10021457",
    "fatigue": "10022855",
    "cough": "10021454",
    "dyspnea": "10041144",
    "dyspnoea": "10041144",
    "headache": "10019233",
    "dizziness": "10009388",
    "fever": "10017912",
}
BIOMARKERS = [
    (r"\begfr\b[^.\n]{0,60}?(mutation|positive|sensitizing)", "EGFR-selective → Asian-skewed"),
    (r"\balk\b[^.\n]{0,40}?(positive|rearrange|fusion)", "ALK-selective"),
    (r"\bkras\s*g12c\b", "KRAS G12C-selective"),
    (r"\bros1\b[^.\n]{0,40}?(positive|rearrange|fusion)", "ROS1-selective"),
    (r"\bbraf\s*v600[ek]?\b", "BRAF-V600-selective"),
    (r"\bmet\s*(exon\s*14|amplification)\b", "MET-selective"),
    (r"\bret\s*(fusion|rearrange)", "RET-selective"),
]
