"""Release-JSON and XML fixture files covering the cases of FIXTURES.md."""

from __future__ import annotations

import json
import os


def party(pid, name, street="", roles=("buyer",), details=None):
    return {"id": pid, "name": name, "roles": list(roles), "details": details or {"k": 1},
            "address": {"streetAddress": street, "locality": "Montreal", "region": "QC",
                        "postalCode": "H1H", "countryName": "Canada"}}


FILE_A = {"releases": [{
    "ocid": "ocds-1", "id": "r1", "date": "2021-01-05T10:00:00-05:00", "tag": ["tender", "award"],
    "initiationType": "tender", "language": "fr",
    "tender": {"id": "t1", "title": "Pont", "procurementMethodDetails": "Appel d'offres public",
               "additionalProcurementCategories": ["works"],
               "procuringEntity": {"id": "P1"},
               "tenderPeriod": {"startDate": "2021-01-01T00:00:00Z", "endDate": "2021-01-20", "durationInDay": 0},
               "numberOfTenderers": 3, "documents": [{"url": "http://a"}, {"title": "no url"}, {"url": "http://b"}],
               "items": [{"id": "i1", "description": "Classification UNSPSC principale",
                          "classification": {"scheme": "UNSPSC", "id": "S3"}},
                         {"id": "i2", "description": "Services", "classification": {"scheme": "UNSPSC", "id": "7200"}},
                         {"id": "i3", "description": "Travaux", "classification": {"scheme": "UNSPSC", "id": "C01"},
                          "additionalClassifications": [{"scheme": "C", "id": "100"}, {"scheme": "C", "id": "G12"}]}],
               "lots": [{"id": "L1", "title": "lot 1"}, {"id": "L2", "title": "lot 2"}, {"title": "no id"}]},
    "parties": [party("P1", "Ville A", "1 rue"), party("P2", "Fourn B", "9 av", roles=("supplier", "tenderer"))],
    "bids": [{"id": "P2", "relatedLots": ["L1", "L2"], "admissible": True, "conform": "1", "value": 99.5},
             {"id": "P9", "value": 10},
             {"id": "P2", "value": 12.25, "valueUnit": "CAD"}],
    "awards": [{"id": "A1", "status": "active", "date": "2021-01-21T00:00:00.123Z",
                "value": {"amount": 100.50, "currency": "CAD"},
                "suppliers": [{"id": "P2", "name": "Fourn B"}, {"id": "P3", "name": "Fourn C"}]}],
    "contracts": [{"id": "C1", "awardID": "A1", "status": "active", "value": {"amount": 120.00, "currency": "CAD"},
                   "dateSigned": "2021-01-25T00:00:00", "period": {"endDate": "2021-06-30T00:00:00"},
                   "amendments": [{"id": "M1", "rationale": "extra", "date": "2021-03-01"}]},
                  {"id": "C2", "awardID": "AX", "value": {"amount": 80},
                   "implementation": {"transactions": [{"id": "T1", "source": "s", "date": "2021-04-01",
                                                        "value": {"amount": 50.25, "currency": "CAD"}}]}}],
    "relatedProcesses": [{"id": "RP1", "relationship": ["planning", "parent"], "title": "x"}],
}, {"id": "no ocid"}]}

FILE_B = {"releases": [{
    "ocid": "ocds-1", "id": "r1b", "date": "garbage", "tag": ["contract"],
    "tender": {"tenderPeriod": {"startDate": "2021-01-02", "endDate": "2021-01-12"},
               "items": [{"id": "only", "description": "Classification UNSPSC principale",
                          "classification": {"id": "9"}}]},
    "parties": [party("P1", "Ville A", "2 rue")],
    "awards": [{"id": "AX", "status": "active", "value": {"amount": 70}, "suppliers": []}],
}, {
    "ocid": "ocds-2", "id": "r2", "tender": {"lots": [{"id": "L1", "title": "reused"}]},
    "parties": [party("P1", "Ville A", "1 rue")],
}]}

FILE_C = {"releases": [{"ocid": "ocds-3", "id": "r3", "parties": [party("P4", "X")],
                        "bids": [{"id": "P4", "relatedLots": ["LZ"], "value": 5}]}]}


def write_release_files(d: str) -> str:
    os.makedirs(d, exist_ok=True)
    for name, doc in [("mensuel_20210101_20210131.json", FILE_A), ("mensuel_20210201_20210228.json", FILE_B),
                      ("hebdo_20210301_20210307.json", FILE_C), ("bad.json", {"other": []})]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            json.dump(doc, f, ensure_ascii=False, indent=1)
    with open(os.path.join(d, "broken.json"), "w") as f:
        f.write('{"releases": [ {"ocid": "x"')
    return d


AVIS_1 = """<?xml version="1.0" encoding="UTF-8"?>
<export>
 <avis><numeroseao>100</numeroseao><numero>N-1</numero><organisme>Ville A & Fils</organisme>
  <municipal>1</municipal><categorieseao>C01 - Bâtiments</categorieseao><type>3</type><nature>3</nature>
  <precision></precision><titre>Pont’s “neuf”</titre><datepublication>2021-1-5 9:5</datepublication>
  <datefermeture>2021-02-01</datefermeture>
  <fournisseurs>
   <fournisseur><neq>111</neq><nomorganisation>Beta inc</nomorganisation><adjudicataire>1</adjudicataire>
     <admissible>1</admissible><montantsoumis>100.5</montantsoumis><montantcontrat>100.5</montantcontrat></fournisseur>
   <fournisseur><neq></neq><nomorganisation>Sans NEQ</nomorganisation><province></province></fournisseur>
   <fournisseur><neq></neq><nomorganisation></nomorganisation></fournisseur>
  </fournisseurs></avis>
 <avis><numeroseao>200</numeroseao><numero>N-2</numero><organisme>Ville A &amp; Fils</organisme>
  <categorieseao>S5 - Services environnementaux</categorieseao><municipal>x</municipal></avis>
 <avis><numeroseao>100</numeroseao><numero>N-1b</numero><organisme>Ville A</organisme>
  <categorieseao>C01 - Bâtiments</categorieseao>
  <fournisseurs><fournisseur><neq>111</neq><nomorganisation>Beta incorporée</nomorganisation></fournisseur></fournisseurs>
 </avis>
</export>"""

CONTRATS_1 = """<export><contrat><numeroseao>100</numeroseao><numero>C-1</numero><datefinale>2021-06-01</datefinale>
<montantfinal>120.00</montantfinal><neqcontractant></neqcontractant></contrat>
<contrat><numeroseao>300</numeroseao><numero>C-3</numero><montantfinal>5</montantfinal></contrat>
<contrat><numeroseao></numeroseao><numero>C-X</numero></contrat></export>"""

CONTRATS_2 = """<export><contrat><numeroseao>100</numeroseao><numero>C-1</numero>
<datepublicationfinale>2021-07-01 10:00:00</datepublicationfinale><montantfinal>130.00</montantfinal></contrat></export>"""

DEPENSES = """<export><avis><numeroseao>100</numeroseao><numero>N-1</numero><depenses>
<depense><datedepense>2021-08-01</datedepense><montantdepense>10.00</montantdepense><description>dep</description></depense>
</depenses></avis><avis><numeroseao>400</numeroseao></avis></export>"""


def write_xml_files(d: str) -> str:
    os.makedirs(d, exist_ok=True)
    for name, text in [("avis_20210101_20210131.xml", AVIS_1), ("contrats_20210101_20210131.xml", CONTRATS_1),
                       ("contrats_revisions_20210101_20210131.xml", CONTRATS_2),
                       ("depenses_20210101_20210131.xml", DEPENSES), ("depenses_20210201_20210228.xml", DEPENSES)]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    return d


# A lot published only in a file that is rejected (its own bid cites an unknown
# lot), and a later file whose bid cites that lot: in file order the second
# file fails too, because the first was rolled back.
CASCADE = [
    ("hebdo_20220101_20220107.json", {"releases": [{"ocid": "c1", "tender": {"lots": [{"id": "LC"}]},
                                                   "parties": [{"id": "PC", "name": "C"}],
                                                   "bids": [{"id": "PC", "relatedLots": ["NOPE"]}]}]}),
    ("hebdo_20220108_20220114.json", {"releases": [{"ocid": "c2", "parties": [{"id": "PD", "name": "D"}],
                                                   "bids": [{"id": "PD", "relatedLots": ["LC"]}]}]}),
    ("hebdo_20220115_20220121.json", {"releases": [{"ocid": "c3", "parties": [{"id": "PE", "name": "E"}],
                                                   "bids": [{"id": "PC"}]}]}),
]


def write_cascade_files(d: str) -> str:
    os.makedirs(d, exist_ok=True)
    for name, doc in CASCADE:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            json.dump(doc, f)
    return d
