"""Fixed vocabularies: relevance phrases, search terms, file types, repositories.

Every operator takes its vocabulary as an argument; the values below are the
defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: relevance phrases and their weights ------------------------

RELEVANCE_THRESHOLD = 10

PHRASE_WEIGHTS: dict[str, int] = {
    # software and exchange standards
    "maxqda": 10,
    "nvivo": 10,
    "atlas.ti": 10,
    "quirkos": 10,
    "dedoose": 10,
    "transana": 10,
    "f4analyse": 10,
    "qualcoder": 10,
    "qda miner": 10,
    "leipzig corpus miner": 10,
    "caqdas": 10,
    "qdas": 10,
    "computer assisted qualitative data analysis": 10,
    "qdpx": 10,
    "mx18": 10,
    "mx20": 10,
    "mx22": 10,
    "mx24": 10,
    "mex22": 10,
    "mex24": 10,
    "nvp": 10,
    "nvpx": 10,
    "qdc": 10,
    "xml project exchange file": 10,
    "refi-qda": 10,
    "maxmaps": 10,
    "smart coding tool": 10,
    "code matrix browser": 10,
    "interactive quote matrix": 10,
    "maxdictio": 10,
    "code relations browser": 10,
    "document portrait": 10,
    # methods and sampling
    "semi-structured interview": 5,
    "in-depth interview": 5,
    "face-to-face in-depth interview": 5,
    "focus group transcript": 5,
    "interview transcript": 5,
    "interview schedule": 5,
    "topic guide": 5,
    "codebook thematic analysis": 5,
    "reflexive thematic analysis": 5,
    "qualitative case study": 5,
    "prolonged engagement": 5,
    "persistent observation": 5,
    "member checking": 5,
    "respondent validation": 5,
    "action research": 5,
    "trustworthiness in qualitative": 5,
    "rich thick description": 5,
    "theoretical sampling": 5,
    "purposive sampling": 5,
    "snowball sampling": 5,
    "constant comparison": 5,
    "interpretative phenomenological analysis": 5,
    "grounded theory": 5,
    "mixed methods": 5,
    "open coding": 5,
    "axial coding": 5,
    "selective coding": 5,
    "ethnographic research": 5,
    "cognitive interviewing": 5,
    "inductive coding": 5,
    "narrative analysis": 5,
    "inductive thematic saturation": 5,
    # general vocabulary
    "thematic analysis": 3,
    "focus group": 3,
    "qualitative data": 3,
    "qualitative research": 3,
    "transcript": 3,
    "open-ended": 3,
    "codebook": 3,
    "memos": 3,
    "field notes": 3,
    "lived experience": 3,
    "creative coding": 3,
    "peer debriefing": 3,
    "intercoder agreement": 3,
    "case variables": 3,
    "observation data": 3,
    "content analysis": 3,
    "summaries": 3,
    "paraphrases": 3,
    "audit trail": 3,
    "coded segments": 3,
    "latent codes": 3,
    "semantic codes": 3,
    "code frequencies": 3,
}

# --- Fixed values: search terms (strict first, then broad) --------------------

STRICT_TERMS: list[str] = [
    "qdpx", "qdc", "nvp", "nvpx", "mx24", "mx22", "mx20", "mx18", "mex24", "mex22",
    "XML Project Exchange File", "CAQDAS", "QDAS", "NVivo", "MAXQDA", "ATLAS.ti",
    "f4analyse", "QDA Miner", "QualCoder", "Quirkos", "Transana", "RQDA", "Dedoose",
    "MAXQDA Analytics Pro", "Leipzig Corpus Miner", "REFI-QDA Standard",
    "Rotterdam Exchange Format Initiative", "REFI-QDA Project", "REFI-QDA Codebook",
    "Interoperability standard", "a qualitative methodology is employed",
    "audit trail", "axial coding", "codebook thematic analysis",
    "cognitive interviewing", "computer assisted qualitative data analysis",
    "constant comparative method", "constant comparison",
    "constructivist grounded theory", "convenience sampling", "criterion sampling",
    "data saturation", "dependability and credibility",
    "ensure the trustworthiness of the research", "ethnographic research",
    "extreme case sampling", "face-to-face in-depth interviews",
    "focus group discussions", "generating initial themes", "grounded theory",
    "in-depth interviews", "inductive coding", "inductive thematic saturation",
    "interpretative phenomenological analysis", "latent codes", "lived experience",
    "maximum variation sampling", "member checking",
    "member checking in qualitative research", "negative case analysis",
    "open coding", "open, axial, and selective coding", "open-ended questions",
    "open-ended responses", "participant observation", "participant validation",
    "peer debriefing", "peer debriefing, negative case analysis",
    "persistent observation", "phenomenological study", "prolonged engagement",
    "prolonged engagement, persistent observation",
    "purposive and snowball sampling", "purposive sampling",
    "qualitative case study approach", "qualitative descriptive research",
    "reflexive thematic analysis", "respondent validation",
    "rich thick description", "selective coding", "semantic codes",
    "semi-structured interviews", "semi-structured interviews were conducted",
    "snowball sampling", "synthesized member checking",
    "the constant comparative method", "thematic analysis",
    "theoretical sampling", "theoretical sampling and saturation",
    "theoretical saturation", "thick description",
    "trustworthiness in qualitative research", "trustworthiness of the research",
    "typical case sampling",
]

BROAD_TERMS: list[str] = [
    "Qualitative Data Analysis", "Qualitative Research", "Qualitative Inquiry",
    "Mixed Methods", "Content Analysis", "Grounded Theory", "Narrative Analysis",
    "Axial Coding", "Action Research", "Thematic Analysis",
    "Semi-structured interviews", "Focus groups", "Interview transcripts",
    "Focus group transcripts", "Qualitative data", "Field notes",
    "Observation data", "Qualitative datasets", "Topic guide",
    "Interview schedule", "Open qualitative data", "Codebook", "Code system",
    "Coding scheme", "Memos", "Code memos", "Document memos", "Annotations",
    "Coded segments", "Paraphrased segments", "Paraphrases", "Emoticodes",
    "Case variables", "Focus group speaker codes", "Document groups",
    "Summary Grid", "Intercoder agreement", "Code co-occurrence",
    "Code frequencies", "Transcription timestamps", "Smart Coding Tool",
    "MAXMaps", "MAXDictio", "Code Matrix Browser", "Code Relations Browser",
    "Interactive Quote Matrix", "Document Portrait", "Codeline", "Word Trends",
    "Questions - Themes - Theories", "Creative Coding",
]

# --- Fixed values: file extensions by family ----------------------------------

INTERCHANGE_EXT = [".qdpx", ".qdc"]
MAXQDA_EXT = [
    ".mx24", ".mx22", ".mx20", ".mx18", ".mx12", ".mx11", ".mx5", ".mx4",
    ".mx3", ".mx2", ".m2k", ".mx24bac", ".mqbac", ".mqex", ".mex24",
    ".mex22", ".mc24", ".mqtc", ".mqdam", ".mqmtr", ".mtr", ".mod", ".mqda",
]
NVIVO_EXT = [".nvpx", ".nvp"]
QUIRKOS_EXT = [".qpd"]
ATLAS_EXT = [".ppj", ".pprj", ".qlt", ".atlasproj", ".hpr7"]
ANALYSIS_EXT = [".loa", ".sea"]
ARCHIVE_EXT = [".zip", ".rar", ".7z", ".tar", ".tar.gz", ".tgz"]
TEXT_EXT = [".pdf", ".docx", ".txt", ".rtf"]
MEDIA_EXT = [".mp3", ".wav", ".mp4"]
# extensions searched for in metadata links
LINK_TARGET_EXT = [
    ".mqda", ".mqbac", ".mqtc", ".mqex", ".mqmtr", ".mx24", ".mx24bac",
    ".mc24", ".mex24", ".mx22", ".mx20", ".mx18", ".mx12", ".mx11",
    ".mx5", ".mx4", ".mx3", ".mx2", ".m2k", ".loa", ".sea", ".mtr",
    ".mod", ".mex22", ".nvp", ".nvpx", ".atlasproj", ".hpr7", ".ppj",
    ".pprj", ".qlt", ".qdpx", ".qdc", ".qpd",
]
# the only extensions the Zenodo reader ranks as tier 1
ZENODO_TIER1_EXT = [".qdpx", ".qdc", ".nvpx", ".mqda"]

# --- Fixed values: repositories -----------------------------------------------

UNKNOWN_REPOSITORY_ID = 99

REPOSITORY_IDS: dict[str, int] = {
    "zenodo": 1, "dryad": 2, "uk-data-service": 3, "qdr": 4,
    "dans_ssh": 5, "dans_life": 5, "dans_archaeology": 5, "dans_physical": 5,
    "dataversenl": 6, "dataverseno": 6, "ada": 7, "sada": 8, "ihsn": 9,
    "aussda": 12, "cessda": 13, "icpsr": 15, "murray": 18,
}

DATAVERSE_HOSTS: dict[str, str] = {
    "qdr": "https://data.qdr.syr.edu",
    "dans_ssh": "https://ssh.datastations.nl",
    "dans_life": "https://lifesciences.datastations.nl",
    "dans_archaeology": "https://archaeology.datastations.nl",
    "dans_physical": "https://phys-techsciences.datastations.nl",
    "dataversenl": "https://dataverse.nl",
    "dataverseno": "https://dataverse.no",
    "murray": "https://dataverse.harvard.edu",
    "aussda": "https://data.aussda.at",
}

NADA_LICENSES: dict[str, str] = {
    "ihsn": "IHSN-Standard-Terms",
    "sada": "DataFirst-Terms-of-Use",
}

PERSON_ROLES = ["UPLOADER", "AUTHOR", "OWNER", "OTHER"]

# Repositories that only mirror records hosted elsewhere; used when the best
# copy of a record is chosen across repositories.
AGGREGATORS = ["cessda"]


@dataclass(frozen=True)
class FileTypes:
    """Extension families and what each family means for a record."""

    software: dict[str, list[str]] = field(
        default_factory=lambda: {
            "REFI-QDA": INTERCHANGE_EXT,
            "MAXQDA": MAXQDA_EXT,
            "NVivo": NVIVO_EXT,
            "Quirkos": QUIRKOS_EXT,
            "ATLAS.ti": ATLAS_EXT,
            "Analysis-Metadata": ANALYSIS_EXT,
        }
    )
    required_software: tuple[str, ...] = ("REFI-QDA", "MAXQDA", "NVivo", "Quirkos")
    text: tuple[str, ...] = tuple(TEXT_EXT)
    archive: tuple[str, ...] = tuple(ARCHIVE_EXT)
    media: tuple[str, ...] = tuple(MEDIA_EXT)

    @property
    def project(self) -> list[str]:
        """Extensions of analysis-project files, all families together."""
        return [e for exts in self.software.values() for e in exts]

    @property
    def required(self) -> list[str]:
        return [e for s in self.required_software for e in self.software[s]]


FILE_TYPES = FileTypes()


def all_terms() -> list[str]:
    """Strict then broad terms, first mention kept."""
    return list(dict.fromkeys(STRICT_TERMS + BROAD_TERMS))
