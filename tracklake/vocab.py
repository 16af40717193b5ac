"""RDF vocabulary: namespaces, class names and predicate names."""

# --- Fixed values: namespaces -------------------------------------------------------------------
IES = "http://ies.data.gov.uk/ontology/ies4#"
ITU = "http://itu.int"
MMSI_SCHEME = "http://itu.int#mmsi-NamingScheme"
ISO8601 = "http://iso.org/iso8601#"
ISO3166 = "http://iso.org/iso3166-alpha3#"
LOCODE = "http://www.un.org/locode#"
EXTENSION = "http://myOntology.org.uk/classes#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"
DATA = "http://ais.data.gov.uk/ais-ies-test#"
FILTER_DATA = "http://stonesoup.dstl.gov.uk/"
ANALYTICS_DATA = "http://trackanalytics.dstl.gov.uk/"

# --- Fixed values: class local names ------------------------------------------------------------
CLASSES = (
    "Arrival", "Assess", "AssessProbability", "AssessToBeAlmostCertain", "AssessToBeHighlyLikely",
    "AssessToBeHighlyUnlikely", "AssessToBeLikelyOrProbably", "AssessToBeRealisticPossibility",
    "AssessToBeRemoteChance", "AssessToBeUnlikely", "Assessor", "BoundingState", "Callsign",
    "ClassOfMeasure", "CommunicationsIdentifier", "CooperAtSea", "CooperingAtSea", "Country",
    "EpsgGeoPointRepresentation", "EpsgParameter1", "EpsgParameter2", "EpsgParameter3", "EpsgParameter4",
    "Follow", "Followed", "Follower", "GeoPoint", "ISO3166Alpha_3", "Identifier", "Latitude",
    "LocationObservation", "LocationTransponder", "Longitude", "Measure", "MeasureValue", "Measurement",
    "Name", "NamingScheme", "Observation", "Observed", "ObservedLocation", "ObservedTarget",
    "Organisation", "ParticularPeriod", "PhiaAssessmentYardStick", "PlaceName", "Port", "PossibleWorld",
    "ProbabilityRepresentation", "Sailing", "Ship", "System", "UN_LOCODE", "UnitOfMeasure",
    "VehicleIdentificationNumber", "VehicleName", "VehicleState", "VehicleUsed", "Vessel",
)

# --- Fixed values: predicate local names --------------------------------------------------------
PREDICATES = (
    "assessed", "epsgCode", "hasName", "hasRepresentation", "hasValue", "inLocation", "inPeriod",
    "inRepresentation", "inScheme", "isEndOf", "isIdentifiedBy", "isPartOf", "isParticipantIn",
    "isParticipationOf", "isStartOf", "iso8601PeriodRepresentation", "measureClass", "measureUnit",
    "observedCharacteristic", "representationValue", "schemeOwner",
)

# --- Fixed values: display prefixes -------------------------------------------------------------
PREFIXES = {
    "data": DATA,
    "ies": IES,
    "iso8601": ISO8601,
    "xsd": XSD,
}

# --- Fixed values: vessel type codes and the classes they map to --------------------------------
VESSEL_CLASS_MAP = [
    ("1001", ["VehicleState", "Observed"], ["CommercialFishingVessel"]),
    ("1002", ["VehicleState", "Observed"], ["FishProcessingVessel"]),
    ("1003", ["VehicleState", "Observed"], ["FreightBarge"]),
    ("1004", ["VehicleState", "Observed"], ["FreightShip"]),
    ("1005", ["VehicleState", "Observed"], ["IndustrialVessel"]),
    ("1007", ["VehicleState", "Observed"], ["MobileOffshoreDrillingUnit"]),
    ("1010", ["VehicleState", "Observed"], ["OffshoreSupplyVessel"]),
    ("1011", ["Ship"], ["OilRecoveryVessel"]),
    ("1012", ["VehicleState", "Observed"], ["InspectedPassengerVessel"]),
    ("1013", ["VehicleState", "Observed"], ["UninspectedPassengerVessel"]),
]
DEFAULT_BASE_CLASSES = ["VehicleState", "Observed"]
DEFAULT_EXTENSION_CLASSES: list[str] = []

_KNOWN = frozenset(CLASSES) | frozenset(PREDICATES)


def ies(name: str) -> str:
    """URI of a class or predicate; an unknown name is a programming error."""
    if name not in _KNOWN:
        raise KeyError(name)
    return IES + name
