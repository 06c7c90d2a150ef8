"""Word lists and patterns that results have to agree on. They are data, in the order in which they are tried."""

from __future__ import annotations

# ---- fixed values: rhetorical moves and their patterns ----
MOVES = {
    "problem": (r"\b(?:problem|challenge|stress shielding|failure|defect|clinical need|drawback)s?\b", r"\b(?:however|nevertheless|despite|although)\b"),
    "gap": (
        r"\b(?:few studies|little is known|remains? (?:unclear|unknown|to be)|has not been|have not been)\b",
        r"\b(?:limited|lack of|to the authors.? best knowledge|not yet)\b",
    ),
    "aim": (
        r"\b(?:this study|the present study|this work) (?:aims?|sought|investigates?|examines?|develops?|proposes?)\b",
        r"\b(?:the objective|the purpose|we (?:aim|propose|develop|investigate|examine|evaluate))\b",
    ),
    "novelty": (r"\b(?:novel|for the first time|first study|new approach|original contribution)\b",),
    "method_action": (
        r"\b(?:was|were) (?:used|employed|modeled|modelled|simulated|fabricated|generated|measured|tested|calculated|derived|validated)\b",
        r"\bwe (?:used|employed|modeled|modelled|simulated|fabricated|generated|measured|tested|calculated|derived|validated)\b",
    ),
    "result": (
        r"\b(?:results?|findings?) (?:show|showed|indicate|indicated|demonstrate|demonstrated|reveal|revealed)\b",
        r"\b(?:increased|decreased|reduced|improved|higher|lower|significant(?:ly)?)\b",
    ),
    "comparison": (r"\b(?:compared with|compared to|relative to|whereas|in contrast|than the)\b",),
    "mechanism": (r"\b(?:because|due to|attributed to|resulted from|mechanism|explained by)\b",),
    "caution": (r"\b(?:may|might|could|appears? to|suggests?|likely|potentially)\b",),
    "limitation": (r"\b(?:limitation|limited by|should be interpreted|caution|future work|further validation)\b",),
    "implication": (r"\b(?:implication|potential for|could be used|may provide|useful tool|clinical application|design guideline)\b",),
}
# ---- fixed values: research domains ----
DOMAINS = {
    "finite_element_biomechanics": r"finite element|biomechan|spine|joint|muscle load|bone modulus",
    "bone_implant": r"implant|prosthe|fixation|bone plate|fusion cage|stress shielding",
    "topology_optimization": r"topolog|simp|level set|design optimization",
    "porous_scaffold": r"porous|scaffold|lattice|tpms|gyroid|trabecular",
    "additive_manufacturing": r"additive manufact|3d print|selective laser|laser powder|slm|fabricat",
    "mechanobiology": r"remodel|bone growth|mechanobiolog|osseointegr",
}
# ---- fixed values: section types by heading, in order of trial ----
SECTION_TYPES = {
    "abstract": "abstract", "background": "introduction", "introduction": "introduction", "methods": "methods", "method": "methods", "methodology": "methods",
    "materials and methods": "methods", "materials & methods": "methods", "methods and materials": "methods", "patients and methods": "methods",
    "subjects and methods": "methods", "experimental": "methods", "experimental section": "methods", "experimental procedures": "methods", "results": "results",
    "results and discussion": "results_discussion", "results & discussion": "results_discussion", "results and discussions": "results_discussion",
    "discussion": "discussion", "discussion and conclusions": "discussion", "limitations": "limitations", "conclusion": "conclusion", "conclusions": "conclusion",
    "concluding remarks": "conclusion", "summary and conclusions": "conclusion", "references": "references", "bibliography": "references", "literature cited": "references",
}
# ---- fixed values: article kinds and their cues, in order of trial ----
KINDS = {
    "systematic_review": ("systematic review", "meta-analysis", "meta analysis", "scoping review"),
    "review": ("review", "overview", "state of the art", "literature survey"),
    "case_report": ("case report", "case series", "case study"),
    "protocol": ("protocol", "study protocol", "registered report"),
    "editorial": ("editorial", "commentary", "letter to the editor", "news"),
}
# ---- fixed values: study design features and their cues (raw substrings) ----
FEATURES = {
    "finite_element_or_computational": ("finite element", "finite-element", "fem", "computational model", "numerical model", "in silico", "simulation", "modelling", "modeling"),
    "experimental_mechanical": ("mechanical test", "mechanical testing", "compression test", "tensile test", "fatigue test", "bench test", "biomechanical"),
    "additive_manufacturing": ("additive manufactur", "3d print", "three-dimensional print", "laser powder", "selective laser"),
    "topology_or_structural_optimization": ("topology optim", "structural optim", "generative design", "lattice optim"),
    "porous_or_lattice_scaffold": ("porous", "scaffold", "lattice", "tpms", "gyroid", "trabecular"),
    "in_vitro": ("in vitro", "cell culture", "cultured cells", "in vitro study"),
    "in_vivo_animal": ("in vivo", "animal", "rat", "mouse", "rabbit", "sheep", "goat", "canine", "porcine"),
    "clinical_or_observational": ("clinical", "patient", "cohort", "retrospective", "prospective", "randomized", "trial"),
    "imaging_or_characterization": ("micro-ct", "micro ct", "computed tomography", "histolog", "microscopy", "characterization", "imaging"),
    "biological_or_mechanobiological": ("osteogen", "osseointegration", "bone ingrowth", "cell", "gene expression", "remodeling", "remodelling"),
}
# ---- fixed values: cues of titles and types that exclude a paper ----
CORRECTION = ("correction", "corrigendum", "erratum", "publisher correction")
RETRACTION = ("retraction", "retracted", "expression of concern")
EDITORIAL = ("editorial", "commentary", "letter to the editor", "news", "in memoriam")
NON_SUBSTANTIVE = (
    "abstract", "meeting abstract", "conference abstract", "poster", "letter", "comment", "news", "brief communication", "short communication", "perspective",
    "viewpoint", "opinion", "conference proceeding", "correction", "erratum", "corrigendum", "retraction", "expression of concern",
)
# ---- fixed values: keywords of the benchmark's strata ----
KEYWORDS = {
    "formula": ("finite element", "finite-element", "topology optimization", "computational", "numerical model", "sensitivity analysis", "mechanical model", "simulation", "simo", "simp"),
    "table": ("systematic review", "meta-analysis", "scoping review", "clinical", "cohort", "randomized", "retrospective", "case series"),
    "figure": ("additive manufacturing", "3d print", "three-dimensional print", "scaffold", "biomaterial", "porous", "lattice", "tpms", "implant"),
}
# ---- fixed values: identifiers in a text ----
DOI = r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+"
CITATION = r"\[[0-9][0-9,\-\x{2013}\s]*\]|\([A-Z][A-Za-z-]+(?:\s+et\s+al\.)?,?\s+\d{4}[a-z]?\)"
PASSIVE = r"(?i)\b(?:is|are|was|were|be|been|being)\s+(?:\w+ly\s+)?\w+(?:ed|en)\b"
FIRST_PERSON = r"(?i)\b(?:we|our|us)\b"
# ---- fixed values: reading states, errors that no retry mends, the domain of journals ----
COMPLETED = ("completed", "complete", "done", "read")
PENDING = ("pending", "queued", "selected", "in_progress", "in-progress", "unread")
PERMANENT_ERRORS = ("http error 404", "http error 410", "does not contain a jats article", "no open access full text")
DOMAIN = (
    r"(?i)biomech|bone|implant|scaffold|porous|topolog|additive|3d\s*print|femur|femoral|spine|spinal|vertebr|interbody|cage|orthop|fracture|trabecular|titanium|lattice|"
    r"tpms|osseointegr|mechanobiolog|finite\s+element|prosthe|hip|joint|fatigue|stress\s+shielding|musculoskeletal|osteogen|fixation|pelvi|mandib"
)
# ---- fixed values: what an overlay of a card may not write, and a locator of a chunk ----
PROTECTED_KEYS = (
    "card_id", "paper_id", "pmcid", "source_record_sha256", "source_hash", "packet_sha256", "packet_path", "source_record", "record_path", "record_id",
    "selection_reason", "primary_stratum", "stratum", "strata", "reading_order", "selection_identity", "source_identity", "status",
)
PROTECTED_ROOTS = ("reading", "selection", "provenance", "source", "identity", "bibliography")
LOCATOR = r"(?<![A-Za-z0-9])S\d{3}:C\d{2}(?![A-Za-z0-9])"
# ---- fixed values: the contract of a completed card ----
PACKET_HEADING = r"(?m)^\s*#{3,}\s+(S\d{3}:C\d{2})(?:\s|$)"
PACKET_SOURCE_HASH = r"(?mi)^-\s*Source SHA-256:\s*`([0-9a-f]{64})`\s*$"
CONFIDENCE = ("high", "moderate", "low")
READER_FIELDS = ("reader_role", "reader_model", "reasoning_effort", "read_at", "adjudication_status")
PRIMARY_READER = "luna_primary"
READER_PROVENANCE = {"reader_model": "gpt-5.6-luna", "reasoning_effort": "max"}
STUDY_TEXTS = ("article_kind", "research_problem", "exact_gap", "objective_or_hypothesis", "study_design")
STUDY_LISTS = ("method_spine", "primary_outcomes")
BOUNDARY = ("measured", "predicted", "inferred", "recommended")
QUALITY_FIELDS = (
    "research_question_design_alignment", "methods_transparency", "validation_credibility", "outcome_uncertainty_reporting", "comparator_fairness",
    "conclusion_proportionality", "overall_credibility",
)
