"""Fixed values of the record, table and figure rules, in the order in which they are tried.

Patterns are written for Java and RE2 alike and tried on the text as it stands.
"""

from __future__ import annotations

# Enzyme names as typed -> underscore vocabulary.
ENZYME_UNDERSCORE = {
    "peroxidase-like": "peroxidase_like",
    "peroxidase like": "peroxidase_like",
    "peroxidase": "peroxidase_like",
    "pod-like": "peroxidase_like",
    "oxidase-like": "oxidase_like",
    "oxidase like": "oxidase_like",
    "oxidase": "oxidase_like",
    "od-like": "oxidase_like",
    "oxd-like": "oxidase_like",
    "catalase-like": "catalase_like",
    "catalase like": "catalase_like",
    "catalase": "catalase_like",
    "cat-like": "catalase_like",
    "superoxide dismutase-like": "superoxide_dismutase_like",
    "superoxide-dismutase-like": "superoxide_dismutase_like",
    "superoxide dismutase like": "superoxide_dismutase_like",
    "sod-like": "superoxide_dismutase_like",
    "sod like": "superoxide_dismutase_like",
    "glucose oxidase-like": "glucose_oxidase_like",
    "glucose-oxidase-like": "glucose_oxidase_like",
    "glucose oxidase like": "glucose_oxidase_like",
    "gox-like": "glucose_oxidase_like",
    "laccase-like": "laccase_like",
    "laccase like": "laccase_like",
    "laccase": "laccase_like",
    "phosphatase-like": "phosphatase_like",
    "phosphatase like": "phosphatase_like",
    "phosphatase": "phosphatase_like",
    "alp-like": "phosphatase_like",
    "esterase-like": "esterase_like",
    "esterase like": "esterase_like",
    "esterase": "esterase_like",
    "nuclease-like": "nuclease_like",
    "nuclease like": "nuclease_like",
    "nuclease": "nuclease_like",
    "nitroreductase-like": "nitroreductase_like",
    "nitroreductase like": "nitroreductase_like",
    "ntr-like": "nitroreductase_like",
    "hydrolase-like": "hydrolase_like",
    "hydrolase like": "hydrolase_like",
    "hydrolase": "hydrolase_like",
    "haloperoxidase-like": "haloperoxidase_like",
    "haloperoxidase like": "haloperoxidase_like",
    "vhpo-like": "haloperoxidase_like",
}
# Abbreviations in the conflict check of enzyme names.
ENZYME_CONFLICT = {
    "pod-like": "peroxidase-like",
    "sod-like": "superoxide-dismutase-like",
    "gpx-like": "glutathione-peroxidase-like",
    "cat-like": "catalase-like",
    "oxd-like": "oxidase-like",
}
# Enzyme names of the final output, hyphen vocabulary; underscore, hyphen and short forms lead to each.
ENZYME_FINAL = {
    "peroxidase-like": ["peroxidase like", "pod-like", "pod_like"],
    "oxidase-like": ["oxidase like", "oxd-like", "oxd_like"],
    "catalase-like": ["catalase like", "cat-like", "cat_like"],
    "superoxide-dismutase-like": ["sod-like", "sod_like"],
    "glucose-oxidase-like": ["gox-like", "gox_like"],
    "glutathione-peroxidase-like": ["gpx-like", "gpx_like"],
    "glutathione-oxidase-like": ["gshox-like", "gshox_like"],
    "laccase-like": [],
    "phosphatase-like": ["alp-like", "alp_like"],
    "esterase-like": [],
    "nuclease-like": [],
    "nitroreductase-like": ["ntr-like", "ntr_like"],
    "hydrolase-like": [],
    "haloperoxidase-like": [],
    "tyrosinase-like": [],
    "cascade-enzymatic": [],
}
# Assay methods as typed.
ASSAY_METHOD = {
    "uv-vis": "UV-vis",
    "uv-vis spectroscopy": "UV-vis",
    "uv/vis": "UV-vis",
    "uv vis": "UV-vis",
    "colorimetric": "colorimetric",
    "colorimetry": "colorimetric",
    "fluorescence": "fluorescence",
    "fluorometric": "fluorescence",
    "fluorimetric": "fluorescence",
    "sers": "SERS",
    "surface-enhanced raman": "SERS",
    "electrochemical": "electrochemical",
    "amperometric": "electrochemical",
    "voltammetric": "electrochemical",
    "chemiluminescence": "chemiluminescence",
    "cl": "chemiluminescence",
    "epr": "EPR",
    "esr": "EPR",
}
# Detection signals; tried in alphabetical order, so that a tie has one answer.
SIGNAL_TYPES = ["EPR signal", "absorbance", "chemiluminescence intensity", "color change", "current", "fluorescence intensity", "impedance", "raman intensity", "voltage"]
# Application types, first match.
APPLICATION = {
    "colorimetric_sensing": [r"(?i)colorimetric\s+(?:detection|sensing|assay|sensor)", r"(?i)colorimetric\s+determination"],
    "fluorescence_sensing": [r"(?i)fluorescen\w*\s+(?:detection|sensing|assay|sensor|probe)", r"(?i)fluorometric\s+(?:detection|assay)"],
    "electrochemical_sensing": [r"(?i)electrochem\w*\s+(?:detection|sensing|sensor|assay)", r"(?i)amperometric\s+(?:detection|sensor)", r"(?i)voltammetric\s+(?:detection|sensor)"],
    "SERS_sensing": [r"(?i)SERS\s+(?:detection|sensing|sensor|assay|substrate)", r"(?i)surface.enhanced\s+raman"],
    "biosensing": [r"(?i)biosens(?:or|ing)", r"(?i)sensing\s+platform"],
    "therapeutic": [r"(?i)therap\w+", r"(?i)tumou?r\s+therapy", r"(?i)cancer\s+therapy", r"(?i)wound\s+heal", r"(?i)anti.?tumor"],
    "antibacterial": [r"(?i)antibacteri\w+", r"(?i)bacteri\w*\s+kill", r"(?i)disinfect", r"(?i)anti.?microbial"],
    "antioxidant": [r"(?i)antioxidant", r"(?i)ROS\s+scaveng", r"(?i)cytoprotect", r"(?i)anti.?inflammatory", r"(?i)radical\s+scaveng"],
    "environmental_detection": [r"(?i)environment\w*\s+(?:detection|monitor)", r"(?i)pollutant\s+(?:detection|degrad)", r"(?i)water\s+(?:treatment|monitor|detection)", r"(?i)degrad\w+\s+pollutant"],
    "food_safety": [r"(?i)food\s+safety", r"(?i)food\s+(?:detection|quality|monitor)"],
    "diagnostic": [r"(?i)diagnos\w+", r"(?i)clinical\s+(?:detection|assay|test)", r"(?i)point.of.care"],
}
# Methods and samples named in a description, first match.
METHOD_NAMED = {
    "colorimetric": [r"(?i)colorimetric|colorimetry|absorbance|UV.vis"],
    "fluorescence": [r"(?i)fluorescen\w*|fluorometric|fluorimetric"],
    "SERS": [r"(?i)SERS|surface.enhanced\s+raman"],
    "electrochemical": [r"(?i)electrochem\w*|amperometric|voltammetric|impedance"],
}
SAMPLE_NAMED = {
    "serum": [r"(?i)\bserum\b"],
    "water": [r"(?i)\bwater\s+(?:sample|sample)?\b"],
    "food": [r"(?i)\bfood\s+(?:sample|extract)?\b"],
    "cell": [r"(?i)\bcell\b|\bcellular\b|\bin\s+vitro\b|\bin\s+vivo\b"],
    "urine": [r"(?i)\burine\b"],
    "plasma": [r"(?i)\bplasma\b"],
    "blood": [r"(?i)\bblood\b"],
    "saliva": [r"(?i)\bsaliva\b"],
    "environmental": [r"(?i)\benvironmental\s+sample\b|\briver\b|\blake\b|\btap\s+water\b"],
}
# Substrates and analytes; looked for in alphabetical order, so that a tie has one answer.
SUBSTRATES = [
    "2,2'-azino-bis", "3,3',5,5'-tetramethylbenzidine", "abts", "amplex red", "ascorbic acid", "catechol", "dcfh", "dcfh-da", "dopamine hydrochloride", "guaiacol", "h2o2", "l-ascorbic acid", "nadh", "nadph",
    "o-phenylenediamine", "opd", "pyrogallol", "taed", "tmb",
]
ANALYTES = [
    "4t1", "aa", "ag+", "al3+", "ascorbic acid", "atrazine", "bisphenol", "bpa", "cancer cells", "carbaryl", "cd2+", "cholesterol", "cr(vi)", "cr6+", "cu+", "cu2+", "cys", "cysteine", "dopamine", "e. coli",
    "escherichia coli", "fe2+", "fe3+", "glucose", "glutathione", "gsh", "h2o2", "hepg2", "hg2+", "hydrogen peroxide", "hypoxanthine", "l-cysteine", "lactate", "malathion", "mcf-7", "mn2+", "paraoxon", "pb2+",
    "phenol", "s. aureus", "sulfite", "tumor cells", "ua", "uric acid", "xanthine", "zn2+",
]
ANALYTE_VERB = r"(?i)\b(?:detect|sens|determin|quantif|monitor)\b"
DETECTED = r"(?i)detect(?:ion|ing)?\s+(?:of\s+)?([A-Za-z0-9+\-]+(?:\s+[A-Za-z0-9+\-]+){0,3})"
# Table types by the number of patterns that match; a tie goes to the earlier type.
TABLE_TYPE = {
    "kinetics_table": [r"(?i)\bkm\b", r"(?i)\bvmax\b", r"(?i)\bkcat\b", r"(?i)\bmichaelis", r"(?i)\bkinetic\s+param", r"(?i)\baffinity\s+constant"],
    "sensing_performance_table": [r"(?i)\bLOD\b", r"(?i)\bdetection\s+limit\b", r"(?i)\blinear\s+range\b", r"(?i)\bsensitivity\b", r"(?i)\bsensing\s+performance\b", r"(?i)\btarget\s+analyte\b"],
    "comparison_table": [r"(?i)\bcomparison\b", r"(?i)\bcompare\b", r"(?i)\bpreviously\s+reported\b", r"(?i)\bref\b.*\bref\b", r"(?i)\bliterature\b"],
    "recovery_table": [r"(?i)\brecovery\b", r"(?i)\bspiked?\b", r"(?i)\bfound\b.*\badded\b", r"(?i)\bRSD\b", r"(?i)\bprecision\b"],
    "characterization_table": [r"(?i)\bBET\b", r"(?i)\bsurface\s+area\b", r"(?i)\bparticle\s+size\b", r"(?i)\bzeta\s+potential\b", r"(?i)\bXPS\b", r"(?i)\bXRD\b", r"(?i)\bICP\b", r"(?i)\bcomposition\b", r"(?i)\bcrystallite\b", r"(?i)\blattice\b"],
}
THIS_WORK_ROW = [
    r"(?i)\bthis\s+work\b", r"(?i)\bcurrent\s+work\b", r"(?i)\bpresent\s+work\b", r"(?i)\bour\s+(?:work|study|material|catalyst|nanozyme|system)\b",
    r"(?i)\bproposed\s+(?:method|sensor|catalyst|nanozyme)\b", r"(?i)\bthis\s+(?:study|paper|article|report)\b",
]
# What a caption and a figure's type say about its kind.
CAPTION_KIND = {
    "kinetics": [r"(?i)\bkinetic", r"(?i)\bKm\b", r"(?i)\bVmax\b", r"(?i)\bMichaelis", r"(?i)\bLineweaver", r"(?i)\bcatalytic\s+efficiency"],
    "application": [r"(?i)\bdetection\b", r"(?i)\bsensing\b", r"(?i)\bLOD\b", r"(?i)\blinear\s+range\b", r"(?i)\bcalibrat", r"(?i)\bselectivity\b", r"(?i)\binterfer"],
    "morphology": [r"(?i)\bSEM\b", r"(?i)\bTEM\b", r"(?i)\bAFM\b", r"(?i)\bmorpholog", r"(?i)\bsurface\b", r"(?i)\bXRD\b", r"(?i)\bXPS\b", r"(?i)\bFT.?IR\b"],
}
TYPE_KIND = {"kinetics": ["kinetic", "michaelis"], "application": ["application", "sensing", "calibrat"], "morphology": ["morphology", "sem", "tem", "characteriz"]}
# Explicit values in captions.
CAPTION_KM = r"(?i)K[_\s]?m\s*[=:≈~]\s*([+-]?\d+\.?\d*(?:[eE][+-]?\d+)?)\s*(mM|μM|uM|nM|pM|M)"
CAPTION_VMAX = r"(?i)V[_\s]?max\s*[=:≈~]\s*([+-]?\d+\.?\d*(?:[eE][+-]?\d+)?)\s*((?:mM|μM|uM|nM|pM|M)\s*(?:/?\s*(?:s|min|h))\s*[⁻^-]?\s*\d*)"
# Physical properties; the first text and pattern that match give value and unit, the sign is not kept.
PHYSICAL = {
    "surface_area": [
        r"(?i)\b(?:specific\s+)?surface\s+area\s*(?:of|was|=|:|≈|~)\s*([\d.]+)\s*(m2/g|m²/g|m2\s*g[-−]1)",
        r"(?i)\bBET\s+surface\s+area\s*(?:of|was|=|:|≈|~)\s*([\d.]+)\s*(m2/g|m²/g)",
        r"(?i)\bBET\s*(?:was|=|:|≈|~)\s*([\d.]+)\s*(m2/g|m²/g)",
    ],
    "zeta_potential": [
        r"(?i)\bzeta\s+potential\s*(?:of|was|=|:|≈|~)\s*[-−]?([\d.]+)\s*(mV)",
        r"(?i)\bsurface\s+charge\s*(?:of|was|=|:|≈|~)\s*[-−]?([\d.]+)\s*(mV)",
        r"(?i)\bsurface\s+potential\s*(?:of|was|=|:|≈|~)\s*[-−]?([\d.]+)\s*(mV)",
        r"(?i)ζ\s*[-−]?\s*potential\s*(?:of|was|=|:|≈|~)\s*[-−]?([\d.]+)\s*(mV)",
        r"(?i)\b(?:showed|exhibited|measured)\s+(?:a\s+)?zeta\s+potential\s+(?:of\s+)?[-−]?([\d.]+)\s*(mV)",
    ],
    "pore_size": [
        r"(?i)\bpore\s+(?:size|diameter|width)\s*(?:of|was|=|:|≈|~)\s*([\d.]+)\s*(nm|Å|μm|um)",
        r"(?i)\baverage\s+pore\s+(?:size|diameter)\s*(?:of|was|=|:|≈|~)\s*([\d.]+)\s*(nm|Å)",
        r"(?i)\bBJH\s+pore\s+(?:size|diameter)\s*(?:of|was|=|:|≈|~)\s*([\d.]+)\s*(nm|Å)",
    ],
}
# Markers of attribution, on lower-case text.
CONTRAST_MARKERS = [
    "in contrast", "compared with", "compared to", "whereas", "while", "on the other hand", "unlike", "different from", "in comparison", "higher than", "lower than", "better than", "worse than",
    "superior to", "inferior to", "as compared", "versus", "vs.",
]
PREVIOUS_WORK = r"\bprevious\s+(?:work|study|report|literature)\b|\breported\s+(?:by|in)\b|\bref\.?\s*\d"
THIS_WORK = (
    r"\bthis\s+work\b|\bcurrent\s+work\b|\bpresent\s+(?:work|study)\b|\bour\s+(?:nanozyme|catalyst|material|system|sample|nanoparticle|result|finding)\b"
    r"|\bhere(?:in|by|after)?\b|\bas-prepared\b|\bas-synthesized\b|\bproposed\b"
)
# Endings of material names.
NAME_SUFFIX = (
    r"(?i)\s+(?:nanoparticles?|NPs?|nanosheets?|nanocubes?|nanorods?|nanoclusters?|nanozymes?|nanocomposites?|nanospheres?|nanoflowers?|nanowires?|nanotubes?|nanostars?|nanobelts?|nanoplates?|nanodots?"
    r"|nanostructures?|nanomaterials?)\s*$"
)
COMPATIBLE_SUFFIXES = [
    "nps", "nanoparticles", "nanoparticle", "nanozyme", "nanocomposite", "nanosheets", "nanosheet", "nanorods", "nanorod", "nanoflowers", "nanoflower", "nanocubes", "nanocube", "nanocluster", "nanoclusters",
]
# Application kinds that go with an enzyme type.
ENZYME_USES = {
    "peroxidase-like": ["sensing", "therapeutic", "antibacterial", "antioxidant", "environmental", "biofilm_inhibition", "other"],
    "oxidase-like": ["sensing", "therapeutic", "antibacterial", "antioxidant", "environmental", "other"],
    "catalase-like": ["therapeutic", "antioxidant", "environmental", "other"],
    "superoxide-dismutase-like": ["therapeutic", "antioxidant", "other"],
    "glutathione-peroxidase-like": ["therapeutic", "antioxidant", "other"],
    "glucose-oxidase-like": ["sensing", "therapeutic", "antibacterial", "environmental", "other"],
    "phosphatase-like": ["sensing", "therapeutic", "environmental", "other"],
    "laccase-like": ["sensing", "environmental", "other"],
    "esterase-like": ["sensing", "environmental", "other"],
    "nitroreductase-like": ["sensing", "therapeutic", "antibacterial", "other"],
    "hydrolase-like": ["sensing", "environmental", "other"],
    "haloperoxidase-like": ["sensing", "antibacterial", "other"],
    "glutathione-oxidase-like": ["sensing", "therapeutic", "antioxidant", "other"],
    "nuclease-like": ["sensing", "therapeutic", "other"],
    "cascade-enzymatic": ["sensing", "therapeutic", "antibacterial", "antioxidant", "environmental", "biofilm_inhibition", "other"],
}
CONCENTRATION_START = ["mm", "μm", "um", "nm", "pm", "mol"]
RATE_PART = ["/s", "s^-1", "s⁻¹", "/min", "min^-1", "min⁻¹", "·s", "s-1"]
# Running headers and footers, contents pages.
HEADER_FOOTER = [r"^\d+$", r"(?i)^page\s+\d+$", r"(?i)^doi:", r"(?i)^https?://", r"(?i)^contents lists available"]
CONTENTS_HEADING = r"(?i)^(?:table\s+of\s+contents?|contents?)\s*$"
CONTENTS_ENTRY = r"(?i)^supplementary\s+(?:figure|fig\.?|table|scheme|note|text|section)\s*S?\d*"
SPACED_CAPITALS = r"\b(?:[A-Z]\s+){2,}[A-Z]\b"
# Fields in which a provider's reply may hold its text.
REPLY_FIELDS = ["output_text", "text", "response", "content", "output", "result"]
# Base score of a table by its type, and the bands of its priority.
TABLE_BASE = {"kinetics_table": 10.0, "sensing_performance_table": 8.0, "characterization_table": 7.0, "comparison_table": 2.0, "recovery_table": 2.0, "general_table": 2.0}
