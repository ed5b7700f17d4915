"""Fixed values that must equal the reference's for equal results.

FIXED VALUES - the category lists, code maps, prefixes and constants below are
the publisher's texts, stated as they appear, in their natural order. Do not
reformat them: string equality decides which notices, contracts and items are
selected.
"""

# ---------------------------------------------------------------- FIXED VALUES
# Construction categories, notice selection of the construction migrations
# (includes the misspelt "préfabriqués" variant).
CONSTRUCTION_NOTICE_CATEGORIES = [
    "G12 - Moteurs, turbines, composants et accessoires connexes",
    "C02 - Ouvrages de génie civil",
    "G31 - Équipement de transport et pièces de rechange",
    "S8 - Contrôle de la qualité, essais et inspections et services de représentants techniques",
    "S5 - Services environnementaux",
    "G19 - Machinerie et outils",
    "S19 - Location à bail ou location d'installations immobilières",
    "G25 - Constructions préfabriquées",
    "G6 - Matériaux de construction",
    "C01 - Bâtiments",
    "IMM1 - Vente de biens immeubles",
    "G25 - Constructions préfabriqués",
    "C03 - Autres travaux de construction",
    "S3 - Services d'architecture et d'ingénierie",
]

# The contract / expense selection of those migrations, and every list of the
# "contract or expense" migration: the same texts without the misspelling.
CONSTRUCTION_CONTRACT_CATEGORIES = [
    "G12 - Moteurs, turbines, composants et accessoires connexes",
    "C02 - Ouvrages de génie civil",
    "G31 - Équipement de transport et pièces de rechange",
    "S8 - Contrôle de la qualité, essais et inspections et services de représentants techniques",
    "S5 - Services environnementaux",
    "G19 - Machinerie et outils",
    "S19 - Location à bail ou location d'installations immobilières",
    "G25 - Constructions préfabriquées",
    "G6 - Matériaux de construction",
    "C01 - Bâtiments",
    "IMM1 - Vente de biens immeubles",
    "C03 - Autres travaux de construction",
    "S3 - Services d'architecture et d'ingénierie",
]

# Item descriptions accepted by the construction variant of the release-JSON
# load (typographic apostrophes, "Imm1").
CONSTRUCTION_ITEM_DESCRIPTIONS = [
    "G12 - Moteurs, turbines, composants et accessoires connexes",
    "C02 - Ouvrages de génie civil",
    "G31 - Équipement de transport et pièces de rechange",
    "S8 - Contrôle de la qualité, essais et inspections et services de représentants techniques",
    "S5 - Services environnementaux",
    "G19 - Machinerie et outils",
    "S19 - Location à bail ou location d’installations immobilières",
    "G25 - Constructions préfabriquées",
    "G6 - Matériaux de construction",
    "C01 - Bâtiments",
    "Imm1 - Vente de biens immeubles",
    "G25 - Constructions préfabriqués",
    "S3 - Services d’architecture et d’ingénierie",
    "C03 - Autres travaux de construction",
]

# Notice type code -> tender procurement method.
METHOD_OPEN_TYPES = [3, 16, 17]
METHOD_DIRECT_TYPES = [9]
METHOD_LIMITED_TYPES = [6, 10, 14]
METHOD_DEFAULT = "open"

# Notice type code -> procurement method details.
METHOD_DETAILS = {
    3: "Contrat adjugé suite à un appel d’offres public",
    6: "Contrat adjugé suite à un appel d’offres sur invitation",
    9: "Contrat octroyé de gré à gré",
    10: "Contrat adjugé suite à un appel d’offres sur invitations",
    14: "Contrat suite à un appel d’offres sur invitation publié au SEAO",
    16: "Contrat conclu relatif aux infrastructures de transport",
    17: "Contrat conclu - Appel d'offres public non publié au SEAO",
}
METHOD_DETAILS_DEFAULT = "Autre type de contrat"

# Precision code -> main procurement category.
MAIN_CATEGORY = {1: "Services professionnels", 2: "Services de nature technique"}
MAIN_CATEGORY_DEFAULT = "Autres"

# Nature code -> additional procurement category (no code 4).
ADDITIONAL_CATEGORY = {
    1: "Approvisionnement (biens)",
    2: "Services",
    3: "Travaux de construction",
    5: "Autre",
    6: "Concession",
    7: "Vente de biens immeubles",
    8: "Vente de biens meubles",
}

OCID_PREFIX = "ocds-ec9k95-"
BUYER_PREFIX = "OP-"
SUPPLIER_PREFIX = "FO-"
SUPPLIER_MISSING_ID = "FO-MISSING"
TRANSACTION_PREFIX = "txn-"
UNSPSC_MAIN_MARKER = "Classification UNSPSC principale"
DEFAULT_CURRENCY = "CAD"
# ------------------------------------------------------------ end FIXED VALUES
