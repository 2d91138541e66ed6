"""Known spellings of reagents and markers."""

from __future__ import annotations

# Canonical name -> lower-case spellings that stand for it in a paper.
GROWTH_FACTORS: dict[str, list[str]] = {
    "HGF": ["hgf", "hepatocyte growth factor", "scatter factor", "hepatopoietin"],
    "BMP4": ["bmp4", "bmp-4", "bone morphogenetic protein 4"],
    "BMP2": ["bmp2", "bmp-2", "bone morphogenetic protein 2"],
    "Activin A": ["activin a", "activin-a", "acta", "act-a", "inhba"],
    "EGF": ["egf", "epidermal growth factor"],
    "FGF2": ["fgf2", "fgf-2", "bfgf", "basic fgf", "basic fibroblast growth factor", "fibroblast growth factor 2"],
    "FGF4": ["fgf4", "fgf-4", "fibroblast growth factor 4"],
    "FGF10": ["fgf10", "fgf-10", "fibroblast growth factor 10"],
    "OSM": ["osm", "oncostatin m", "oncostatin-m"],
    "Wnt3a": ["wnt3a", "wnt-3a", "wnt 3a"],
    "KGF": ["kgf", "keratinocyte growth factor"],
    "FGF7": ["fgf7", "fgf-7"],
    "VEGF": ["vegf", "vascular endothelial growth factor", "vegf-a", "vegfa"],
    "TGFα": ["tgfα", "tgf-α", "tgf-alpha", "tgfalpha", "tgfa", "transforming growth factor alpha"],
    "TGFβ": ["tgfβ", "tgf-β", "tgf-beta", "tgfbeta", "tgfb", "tgfb1", "tgf-β1", "transforming growth factor beta"],
    "FGF1": ["fgf1", "fgf-1", "acidic fgf", "afgf"],
    "PDGF": ["pdgf", "platelet-derived growth factor"],
    "SCF": ["scf", "stem cell factor", "kit ligand", "kitl"],
    "IGF-1": ["igf-1", "igf1", "insulin-like growth factor 1"],
    "DKK1": ["dkk1", "dkk-1", "dickkopf-1", "dickkopf 1"],
    "Noggin": ["noggin"],
    "R-Spondin": ["r-spondin", "rspondin", "r-spondin 1", "rspo1"],
    "Jagged-1": ["jagged-1", "jagged1", "jag1"],
}

SMALL_MOLECULES: dict[str, list[str]] = {
    "CHIR99021": ["chir99021", "chir-99021", "chir 99021", "chir"],
    "SB431542": ["sb431542", "sb-431542", "sb 431542"],
    "A83-01": ["a83-01", "a8301", "a 83-01"],
    "LDN193189": ["ldn193189", "ldn-193189", "ldn 193189", "ldn"],
    "dexamethasone": ["dexamethasone", "dex"],
    "DMSO": ["dmso", "dimethyl sulfoxide", "dimethylsulfoxide"],
    "compound E": ["compound e", "cpd e"],
    "Y-27632": ["y-27632", "y27632", "rock inhibitor y-27632"],
    "SB203580": ["sb203580", "sb-203580"],
    "dorsomorphin": ["dorsomorphin", "compound c", "dors"],
    "valproic acid": ["valproic acid", "vpa", "sodium valproate"],
    "nicotinamide": ["nicotinamide", "nam", "niacinamide"],
    "retinoic acid": ["retinoic acid", "all-trans retinoic acid", "atra"],
    "hydrocortisone": ["hydrocortisone", "hc"],
    "insulin": ["insulin"],
    "ascorbic acid": ["ascorbic acid", "vitamin c", "l-ascorbic acid"],
    "sodium butyrate": ["sodium butyrate", "nab", "butyrate"],
    "IWP2": ["iwp2", "iwp-2"],
    "IWR1": ["iwr1", "iwr-1", "iwr1-endo"],
    "PD0325901": ["pd0325901", "pd-0325901", "pd"],
    "SU5402": ["su5402", "su-5402"],
    "forskolin": ["forskolin", "fsk"],
    "dihexa": ["dihexa"],
    "5-aza-2′-deoxycytidine": ["5-aza-2'-deoxycytidine", "5-aza", "5aza", "decitabine", "5-azacytidine", "azacytidine"],
    "trichostatin A": ["trichostatin a", "tsa"],
    "XAV939": ["xav939", "xav-939"],
    "ITS": ["its", "insulin-transferrin-selenium"],
    "rapamycin": ["rapamycin", "sirolimus"],
    "SB216763": ["sb216763", "sb-216763"],
}

MARKERS: dict[str, list[str]] = {
    "ALB": ["alb", "albumin", "human albumin", "serum albumin"],
    "AFP": ["afp", "alpha-fetoprotein", "α-fetoprotein", "alpha fetoprotein", "alphafetoprotein"],
    "HNF4A": [
        "hnf4a", "hnf4α", "hnf4alpha", "hnf-4a", "hnf-4α", "hepatocyte nuclear factor 4 alpha", "hepatocyte nuclear factor 4a",
    ],
    "SOX17": ["sox17", "sox-17"],
    "FOXA2": ["foxa2", "foxa-2", "hnf3β", "hnf3beta", "hnf-3β", "hnf3b"],
    "CXCR4": ["cxcr4", "cxcr-4", "cd184"],
    "CYP3A4": ["cyp3a4", "cyp-3a4", "cytochrome p450 3a4"],
    "CYP1A2": ["cyp1a2", "cyp-1a2", "cytochrome p450 1a2"],
    "CYP2C9": ["cyp2c9", "cyp-2c9"],
    "CYP2B6": ["cyp2b6", "cyp-2b6"],
    "CYP2D6": ["cyp2d6", "cyp-2d6"],
    "CYP2C19": ["cyp2c19"],
    "OCT4": ["oct4", "oct-4", "oct3/4", "pou5f1"],
    "NANOG": ["nanog"],
    "AAT": [
        "aat", "serpina1", "alpha-1-antitrypsin", "a1at", "α1-antitrypsin", "alpha-1 antitrypsin", "α1at", "a1-antitrypsin",
    ],
    "TTR": ["ttr", "transthyretin", "prealbumin"],
    "ASGR1": ["asgr1", "asgpr1", "asialoglycoprotein receptor"],
    "TBX3": ["tbx3"],
    "PROX1": ["prox1", "prox-1"],
    "EpCAM": ["epcam", "ep-cam", "cd326", "epithelial cell adhesion molecule"],
    "CK18": ["ck18", "krt18", "cytokeratin 18", "keratin 18"],
    "CK19": ["ck19", "krt19", "cytokeratin 19", "keratin 19"],
    "CK7": ["ck7", "krt7", "cytokeratin 7", "keratin 7"],
    "GATA4": ["gata4", "gata-4"],
    "GATA6": ["gata6", "gata-6"],
    "SOX9": ["sox9"],
    "HHEX": ["hhex", "hex"],
    "HNF1B": ["hnf1b", "hnf1β", "hnf-1b", "hnf-1β", "hnf1beta"],
    "HNF1A": ["hnf1a", "hnf1α", "hnf-1a", "hnf-1α", "hnf1alpha"],
    "HNF6": ["hnf6", "onecut1", "oc-1"],
    "FOXA1": ["foxa1", "foxa-1", "hnf3α", "hnf3alpha"],
    "DLK1": ["dlk1", "dlk-1", "delta-like 1"],
    "GSC": ["gsc", "goosecoid"],
    "MIXL1": ["mixl1"],
    "SSEA4": ["ssea4", "ssea-4"],
    "TRA-1-60": ["tra-1-60", "tra160"],
    "TRA-1-81": ["tra-1-81", "tra181"],
    "A1AT": ["a1at", "α1at"],
    "NTCP": ["ntcp", "slc10a1", "sodium taurocholate cotransporting polypeptide"],
    "MRP2": ["mrp2", "abcc2"],
    "BSEP": ["bsep", "abcb11"],
    "UGT1A1": ["ugt1a1"],
    "TAT": ["tat", "tyrosine aminotransferase"],
    "TDO2": ["tdo2", "tryptophan 2,3-dioxygenase"],
    "G6PC": ["g6pc", "glucose-6-phosphatase"],
    "PCK1": ["pck1", "pepck", "phosphoenolpyruvate carboxykinase"],
}
