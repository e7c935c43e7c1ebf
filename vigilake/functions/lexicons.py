"""The word lists, patterns and bands that results depend on. Each is the default of a parameter."""

SALTS = ("HCL", "HYDROCHLORIDE", "SODIUM", "POTASSIUM", "MALEATE", "SUCCINATE", "PHOSPHATE", "TARTRATE", "BESYLATE", "MESYLATE", "ACETATE", "FUMARATE", "CITRATE", "CALCIUM", "BROMIDE")
ROUTES = ("ORAL", "IV", "INTRAVENOUS", "IM", "INTRAMUSCULAR", "SC", "SUBCUTANEOUS", "INJECTION", "INFUSION", "TOPICAL", "INHALATION", "OPHTHALMIC", "NASAL", "PO")
DOSAGE_FORMS = (
    "TABLET", "TAB", "TABS", "CAPSULE", "CAP", "CAPS", "CREAM", "GEL", "SOLUTION", "SUSPENSION", "SYRUP", "SPRAY", "POWDER", "INJ", "SOL", "SOLN", "AMP", "SUSP", "OINT", "OINTMENT",
    "LOTION", "PATCH", "DROP", "DROPS", "LOZENGE", "ELIXIR", "EMULSION", "GRANULE", "GRANULES", "VIAL", "AMPOULE",
)
FORMULATIONS = ("GASTRO", "RESISTANT", "ENTERIC", "LIQUID", "LYOPHILIZED", "LYOPHILISED", "RECONSTITUTED")
NAME_NOISE = ("FOR", "WITH", "AND", "THE", "USP", "NF", "BP", "EP", "PRN", "NTE", "VIA", "PER", "USE", "NOT", "NEB", "NEBS")
RELEASE_MODIFIERS = ("EXTENDED", "RELEASE", "MODIFIED", "CONTROLLED", "DELAYED", "IMMEDIATE", "SUSTAINED", "PROLONGED", "SLOW", "ER", "XR", "SR", "CR", "LA", "XL", "RETARD", "DEPOT")
NOISE = (*SALTS, *DOSAGE_FORMS, *ROUTES, *FORMULATIONS, *RELEASE_MODIFIERS)  # a longer list is a parameter
COMPANIES = ("PFIZER", "NOVARTIS", "ROCHE", "SANOFI", "MERCK", "BAYER", "ASTRAZENECA", "GSK", "MYLAN", "TEVA", "SANDOZ", "BRISTOL", "SQUIBB", "ABBVIE")
NON_INGREDIENTS = (
    "HUMAN", "HUMANA", "NORMAL", "STERILE", "PURIFIED", "UNKNOWN", "UNSPECIFIED", "OTHER", "AQUEOUS", "CONCENTRATE", "NOS", "INGREDIENT", "INGREDIENTS", "ACTIVE", "INACTIVE", "WATER", "SALINE",
    "DE", "VON", "VAN", "DU", "EL", "LA", "LAS", "LOS",
)
BRACKET_QUALIFIERS = ("UNKNOWN", "GENERIC", "BLINDED", "FORMULATION", "STRENGTH", "MG", "MCG", "ML", "IU")
GREEK = ("ALPHA", "BETA", "GAMMA", "DELTA", "EPSILON", "THETA", "LAMBDA", "MU", "OMEGA")
SUSPICIOUS = (
    "(UNKNOWN)", "(FORMULATION UNKNOWN)", "(GENERIC) (UNKNOWN)", "CHINESE HERBAL", "HERBAL MEDICINES", "CARDIOVASCULAR DRUG UNKNOWN", "ALLERGY SHOT", "NOT A DRUG", "A POSITIVE PLAQ", "DIET AID",
    "5000 DIET AID", "DRUG UNKNOWN", "ANTIBIOTICS (ANTIBIOTICS)", "VACCINE UNKNOWN",
)
NO_DRUGS = ("COLONEL", "BUTTOCKS", "MANTOUX", "CHOCOLA", "MA DOPARK", "OTHER ANALGESICS", "MULTIVITAMIN", "POLLENS")
EXCLUDED_CLASSES = ("Surgical and medical procedures", "Social circumstances", "Product issues")
EXCLUDED_REPORTERS = ("Unknown", "Lawyer", "Consumer or non-health professional")
AGE_BANDS = (("infancy", 0, 1), ("toddler", 1, 2), ("early_childhood", 2, 6), ("middle_childhood", 6, 12), ("early_adolescence", 12, 18))
LAST_BAND = ("late_adolescence", 18, 21)
AGE_UNITS = {"Year": 1, "Month": 12, "Week": 52, "Day": 365, "Hour": 8760}
