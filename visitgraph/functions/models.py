"""Dimension tables: model names and site codes."""

from __future__ import annotations

import re

# Model names by group.
BASE_MODELS = ["Affiniti 30", "Affiniti 50", "Affiniti 70", "EPIQ 5G", "EPIQ 7G", "EPIQ 7+", "EPIQ Elite", "EPIQ CVx", "CX30", "CX50"]
GROUP_NAMES = ["EPIQ", "Affiniti", "CX"]
MODELS = {
    "ultrasound": ["Affiniti 50C", "Affiniti 50G", "Affiniti 50W", "Affiniti 70C", "Affiniti 70W", "Affiniti CVx", "ClearVue 550", "EnVisor", "EPIQ 5", "EPIQ 5C", "EPIQ 5W", "EPIQ 7", "EPIQ 7C", "EPIQ CVxi", "HD7", "HD15", "iE33", "iU22", "Sparq"],
    "patient_monitors": ["CM10", "CM12", "M3046A", "MP2", "MP5", "MP20", "MP30", "MP50", "MP70", "MP80", "MP90", "MX40", "MX400", "MX450", "MX500", "MX550", "MX700", "MX750", "MX800", "MX850", "MR200", "MR400", "VM4", "VM6", "VM8", "VS4", "X2", "X3"],
    "fetal_monitors": ["FM20", "FM30", "FMX-4"],
    "electrocardiographs": ["DigiTrak XT", "PageWriter Trim III", "TC20", "TC30", "TC35", "TC50", "TC70"],
    "defibrillators": ["DFM100", "HeartStart MRx", "HeartStart XL", "HeartStart XL+"],
    "monitoring_modules": ["MMX", "M1006B", "M1012A", "M1020B", "M1027A", "M1027B", "M1029A", "M1034B", "M1116B", "M1116C", "M2501A", "M3001A", "M3014A", "M3015A", "M8048A"],
    "telemetry_and_central_stations": ["PIIC iX", "TRx4851A"],
}
# Other labels of the same models.
ALIASES = {"M2702A": "FM20", "M2703A": "FM30", "M3002A": "X2", "M8001A": "MP20", "M8008A": "MP80", "M8010A": "MP90", "M8102A": "MP2", "M8105A": "MP5", "Efficia CM10": "CM10", "Efficia CM12": "CM12", "Efficia DFM100": "DFM100", "Avalon FM20": "FM20", "Avalon FM30": "FM30", "Expression MR200": "MR200", "Expression MR400": "MR400", "Trim III": "PageWriter Trim III", "MRx": "HeartStart MRx", "XL": "HeartStart XL", "XL+": "HeartStart XL+", "PIIC iX 866389": "PIIC iX", "EPIQ 7 Plus": "EPIQ 7+"}
SERIES = {"PageWriter": r"TC\d+", "IntelliVue": r"(MP|MX)\d+|X[23]", "SureSigns": r"V[MS]\d"}
# Site codes and what they stand for.
SITES = {"QMH": "QMH", "QEH": "QEH", "KWH": "KWH", "KH": "KH", "PYN": "PYNEH", "PYNEH": "PYNEH", "PMH": "PMH", "HKCH": "HKCH", "PWH": "PWH", "UCH": "UCH", "TMH": "TMH", "NDH": "NDH", "GH": "GH"}


def label_key(label: str) -> str:
    """Upper case, letters, digits and plus signs only."""
    return re.sub(r"[^A-Z0-9+]", "", label.upper())


#: Names that a misread label may be corrected to.
CORRECTABLE = [*BASE_MODELS, "Affiniti 70G", *sorted(GROUP_NAMES)]
ALL_MODELS = [m for group in MODELS.values() for m in group]
EXACT_ONLY = [m for name, group in MODELS.items() if name != "ultrasound" for m in group]
#: Label key to model: every name, alias and series spelling.
BY_KEY = (
    {label_key(m): m for m in [*CORRECTABLE, *ALL_MODELS]}
    | {label_key(f"{series} {m}"): m for series, form in SERIES.items() for m in ALL_MODELS if re.fullmatch(form, m)}
    | {label_key(a): m for a, m in ALIASES.items()}
)
