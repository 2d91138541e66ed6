"""Reference dimensions: gene panel, stage aliases, section priorities, vocabularies."""

from __future__ import annotations

# Target gene panel by category.
TARGET_GENES: dict[str, list[str]] = {
    "pluripotency": ["POU5F1", "NANOG", "SOX2", "LIN28A"],
    "definitive_endoderm": ["SOX17", "FOXA2", "CXCR4", "GATA4", "EOMES", "GSC", "MIXL1"],
    "hepatic_progenitor": ["HNF4A", "AFP", "TBX3", "PROX1", "HNF1B", "ONECUT1", "ONECUT2", "HHEX"],
    "mature_hepatocyte": [
        "ALB", "CYP3A4", "CYP1A2", "CYP2C9", "CYP2D6", "CYP2E1", "SERPINA1", "TTR",
        "TDO2", "TAT", "ASGR1", "SLC10A1", "SLCO1B1", "UGT1A1", "ADH1A", "ALDOB",
    ],
    "fetal_hepatocyte": ["AFP", "CYP3A7", "H19", "DLK1", "GPC3"],
    "cholangiocyte": ["KRT19", "KRT7", "SOX9", "EPCAM"],
    "mesenchymal": ["VIM", "ACTA2", "COL1A1", "S100A4"],
}

# Alias -> symbol.
GENE_ALIASES: dict[str, str] = {
    "OCT4": "POU5F1", "OCT-4": "POU5F1", "OCT3/4": "POU5F1", "AAT": "SERPINA1",
    "NTCP": "SLC10A1", "OATP1B1": "SLCO1B1", "ALBUMIN": "ALB", "ALPHA-FETOPROTEIN": "AFP",
    "CK19": "KRT19", "CK7": "KRT7", "EPCAM": "EPCAM", "SMA": "ACTA2", "ALPHA-SMA": "ACTA2",
}

# Public Ensembl ids of the panel genes.
ENSEMBL_TO_SYMBOL: dict[str, str] = {
    "ENSG00000204531": "POU5F1",
    "ENSG00000111704": "NANOG",
    "ENSG00000181449": "SOX2",
    "ENSG00000131914": "LIN28A",
    "ENSG00000164736": "SOX17",
    "ENSG00000125798": "FOXA2",
    "ENSG00000163508": "CXCR4",
    "ENSG00000136574": "GATA4",
    "ENSG00000135925": "EOMES",
    "ENSG00000173542": "GSC",
    "ENSG00000185155": "MIXL1",
    "ENSG00000101076": "HNF4A",
    "ENSG00000081051": "AFP",
    "ENSG00000135111": "TBX3",
    "ENSG00000117707": "PROX1",
    "ENSG00000108753": "HNF1B",
    "ENSG00000169856": "ONECUT1",
    "ENSG00000119547": "ONECUT2",
    "ENSG00000152049": "HHEX",
    "ENSG00000163898": "ALB",
    "ENSG00000160868": "CYP3A4",
    "ENSG00000140505": "CYP1A2",
    "ENSG00000138109": "CYP2C9",
    "ENSG00000186377": "CYP2D6",
    "ENSG00000130649": "CYP2E1",
    "ENSG00000197249": "SERPINA1",
    "ENSG00000118271": "TTR",
    "ENSG00000151790": "TDO2",
    "ENSG00000198650": "TAT",
    "ENSG00000141505": "ASGR1",
    "ENSG00000100652": "SLC10A1",
    "ENSG00000134538": "SLCO1B1",
    "ENSG00000241635": "UGT1A1",
    "ENSG00000187758": "ADH1A",
    "ENSG00000136872": "ALDOB",
    "ENSG00000067064": "CYP3A7",
    "ENSG00000130600": "H19",
    "ENSG00000185559": "DLK1",
    "ENSG00000082781": "GPC3",
    "ENSG00000171345": "KRT19",
    "ENSG00000135480": "KRT7",
    "ENSG00000125398": "SOX9",
    "ENSG00000119888": "EPCAM",
    "ENSG00000026025": "VIM",
    "ENSG00000107796": "ACTA2",
    "ENSG00000108821": "COL1A1",
    "ENSG00000196154": "S100A4",
}

# Public Entrez ids of the panel genes.
ENTREZ_TO_SYMBOL: dict[str, str] = {
    "5460": "POU5F1",
    "79923": "NANOG",
    "6657": "SOX2",
    "79727": "LIN28A",
    "64321": "SOX17",
    "3170": "FOXA2",
    "7852": "CXCR4",
    "2626": "GATA4",
    "8320": "EOMES",
    "145258": "GSC",
    "83881": "MIXL1",
    "3172": "HNF4A",
    "174": "AFP",
    "6926": "TBX3",
    "5629": "PROX1",
    "6928": "HNF1B",
    "3175": "ONECUT1",
    "9480": "ONECUT2",
    "3087": "HHEX",
    "213": "ALB",
    "1576": "CYP3A4",
    "1544": "CYP1A2",
    "1559": "CYP2C9",
    "1565": "CYP2D6",
    "1571": "CYP2E1",
    "5265": "SERPINA1",
    "7276": "TTR",
    "6999": "TDO2",
    "6898": "TAT",
    "432": "ASGR1",
    "6554": "SLC10A1",
    "10599": "SLCO1B1",
    "54658": "UGT1A1",
    "124": "ADH1A",
    "229": "ALDOB",
    "1551": "CYP3A7",
    "283120": "H19",
    "8788": "DLK1",
    "2719": "GPC3",
    "3880": "KRT19",
    "3855": "KRT7",
    "6662": "SOX9",
    "4072": "EPCAM",
    "7431": "VIM",
    "59": "ACTA2",
    "1277": "COL1A1",
    "6275": "S100A4",
}

PANEL: list[str] = sorted({g for genes in TARGET_GENES.values() for g in genes})

# The first category that lists a gene owns it.
GENE_CATEGORY: dict[str, str] = {}
for _category, _genes in TARGET_GENES.items():
    for _gene in _genes:
        GENE_CATEGORY.setdefault(_gene, _category)

# Expected expression direction by category; AFP rises and falls.
CATEGORY_DIRECTION = {
    "pluripotency": "down", "definitive_endoderm": "transient_up", "hepatic_progenitor": "up",
    "mature_hepatocyte": "up", "fetal_hepatocyte": "transient_up", "cholangiocyte": "variable",
    "mesenchymal": "low",
}
EXPECTED_DIRECTION = {g: CATEGORY_DIRECTION[c] for c, gs in TARGET_GENES.items() for g in gs}
EXPECTED_DIRECTION["AFP"] = "transient_up"

# Weight of a direction in the readout score.
DIRECTION_WEIGHT = {"up": 1.0, "down": 0.9, "transient_up": 0.95, "low": 0.3, "variable": 0.3}

# Phrase found in sample titles -> stage label.
STAGE_ALIASES: dict[str, str] = {
    "ipsc": "pre_treatment",
    "esc": "pre_treatment",
    "hesc": "pre_treatment",
    "undifferentiated": "pre_treatment",
    "pluripotent": "pre_treatment",
    "stem cell": "pre_treatment",
    "d0": "pre_treatment",
    "day0": "pre_treatment",
    "de": "definitive_endoderm",
    "definitive endoderm": "definitive_endoderm",
    "definitive_endoderm": "definitive_endoderm",
    "endoderm": "definitive_endoderm",
    "he": "hepatic_endoderm",
    "hepatic endoderm": "hepatic_endoderm",
    "hepatic specification": "hepatic_endoderm",
    "hepatic_endoderm": "hepatic_endoderm",
    "hb": "hepatoblast",
    "hepatoblast": "hepatoblast",
    "hepatic progenitor": "hepatoblast",
    "hepatic_progenitor": "hepatoblast",
    "hp": "hepatoblast",
    "hlc": "mature_hepatocyte",
    "ihep": "mature_hepatocyte",
    "hepatocyte-like": "mature_hepatocyte",
    "hepatocyte like": "mature_hepatocyte",
    "mature hepatocyte": "mature_hepatocyte",
    "maturation": "mature_hepatocyte",
    "hepatocyte": "mature_hepatocyte",
}

# Stage label -> words looked for in a protocol's stage names.
STAGE_KEYWORDS: dict[str, list[str]] = {
    "pre_treatment": ["pre_treatment", "pre-treatment", "undifferentiated", "ipsc", "esc", "seeding"],
    "definitive_endoderm": ["definitive_endoderm", "definitive endoderm", "endoderm", "de "],
    "hepatic_endoderm": ["hepatic_endoderm", "hepatic endoderm", "hepatic specification", "specification"],
    "hepatoblast": ["hepatoblast", "hepatic progenitor", "progenitor", "expansion"],
    "mature_hepatocyte": ["maturation", "hepatocyte", "hlc", "ihep", "mature"],
}

# Section kind <- words in its title (first kind that matches), and trim priority.
SECTION_WORDS: dict[str, list[str]] = {
    "methods": ["method", "material", "experimental", "procedure", "cell culture",
                "differentiation protocol", "cell maintenance"],
    "results": ["result"],
    "discussion": ["discuss"],
    "introduction": ["introduc", "background"],
    "supplementary": ["supplement", "supporting", "additional file"],
    "abstract": ["abstract"],
}
SECTION_PRIORITY = {"abstract": 0, "methods": 0, "results": 1, "supplementary": 3,
                    "introduction": 4, "discussion": 5}

# Text budgets in characters that a prompt may be held to; nothing is cut unless one is passed.
PAPER_BUDGET = 120_000
SUPPLEMENT_BUDGET = 40_000
REFERENCE_BUDGET = 60_000

# Vocabularies.
EXTRACTABLE = ["primary_protocol", "disease_model", "methods_tool"]
REVIEW = "review"
TRIAGE_CATEGORIES = EXTRACTABLE + [REVIEW, "tangential", "not_relevant"]
FLAG_REASONS = ["not_reported", "behind_paywall_reference", "ambiguous_text",
                "in_supplement_not_available", "kit_composition_unknown", "qualitative_only"]
CONTEXT_RANK = {"own_data": 3, "referenced": 2, "ambiguous": 1}
RATING_SCORE = {"correct": 1.0, "mostly_correct": 0.75, "partially_correct": 0.5, "incorrect": 0.0}
# Lower bounds, highest first.
CONFIDENCE_BUCKETS = [("high", 0.85, 1.01), ("good", 0.70, 0.85), ("fair", 0.50, 0.70)]

# Sequencing platforms whose series matrix has no gene rows.
RNASEQ_PLATFORMS = [
    "GPL16791", "GPL24676", "GPL11154", "GPL18573", "GPL20301", "GPL17303", "GPL24247", "GPL15520",
    "GPL21290", "GPL20795", "GPL18460", "GPL21697", "GPL21273", "GPL29480", "GPL28352", "GPL23479",
    "GPL25947", "GPL24106", "GPL23227", "GPL23159", "GPL21103", "GPL19117", "GPL19057", "GPL34281",
    "GPL30173", "GPL13112",
]

# Confidence of a measurement by the path it came from.
SOURCE_CONFIDENCE = {"series_matrix": 0.95, "supplementary": 0.90, "repository": 0.90,
                     "disk": 0.85, "disk_all": 0.80, "deg": 0.85, "supplement_matrix": 0.80}
