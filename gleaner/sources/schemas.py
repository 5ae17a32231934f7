"""Schemas of the inputs and outputs; JSON is never inferred."""

RECORD = """id STRING, attributes STRUCT<doi: STRING, titles: ARRAY<STRUCT<title: STRING>>,
creators: ARRAY<STRUCT<name: STRING, givenName: STRING, familyName: STRING, nameType: STRING>>,
descriptions: ARRAY<STRUCT<description: STRING, descriptionType: STRING>>,
relatedIdentifiers: ARRAY<STRUCT<relatedIdentifier: STRING, relatedIdentifierType: STRING>>,
alternateIdentifiers: ARRAY<STRUCT<alternateIdentifier: STRING, alternateIdentifierType: STRING>>,
identifiers: ARRAY<STRUCT<identifier: STRING, identifierType: STRING>>>"""

EVIDENCE = """STRUCT<arxiv_id_found: STRING, arxiv_id_location: STRING, arxiv_skipped: STRING, name_similarity_score: DOUBLE, name_containment_score: DOUBLE,
name_token_overlap_score: DOUBLE, name_fuzzy_score: DOUBLE, name_skipped: STRING, author_matches: ARRAY<STRUCT<contributor: STRING, author: STRING, confidence: DOUBLE>>, author_skipped: STRING>"""

ENRICHMENT = f"""doi STRING, sources ARRAY<STRUCT<name: STRING, contributorType: STRING, nameType: STRING>>,
processResources ARRAY<STRUCT<relatedIdentifier: STRING, relatedIdentifierType: STRING, relationType: STRING, resourceTypeGeneral: STRING>>,
action STRING, field STRING, originalValue STRING, enrichedValue STRUCT<relatedIdentifier: STRING, relatedIdentifierType: STRING, relationType: STRING>,
created STRING, updated STRING, produced STRING, _validation STRUCT<is_valid: BOOLEAN, method: STRING, error: STRING>,
_promotion STRUCT<promoted: BOOLEAN, skipped: BOOLEAN, skip_reason: STRING, original_relation: STRING, signals: ARRAY<STRING>, evidence: {EVIDENCE}>"""

CHECKPOINT = "url STRING, valid BOOLEAN, method STRING, error STRING, checked_at STRING"
CONTRIBUTORS = "ARRAY<STRUCT<login: STRING, name: STRING, email: STRING>>"
METADATA = f"url STRING, description STRING, readme_content STRING, contributors {CONTRIBUTORS}, fetch_error STRING"
_TEXT = "STRUCT<text: STRING>"
GRAPHQL = f"""data MAP<STRING, STRUCT<id: STRING, description: STRING, readme_md: {_TEXT}, readme_rst: {_TEXT}, readme_txt: {_TEXT}, readme_plain: {_TEXT},
mentionableUsers: STRUCT<nodes: {CONTRIBUTORS}>>>, errors ARRAY<STRUCT<path: ARRAY<STRING>, type: STRING, message: STRING>>, message STRING"""
PROBE = "url STRING, valid BOOLEAN, method STRING, error STRING"
