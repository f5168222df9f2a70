"""Names of the metadata columns that landed and modelled tables carry.

Fixed values: these are the names existing landed tables and consumers use.
"""

RAW_ID = "_airbyte_raw_id"
EXTRACTED_AT = "_airbyte_extracted_at"
META = "_airbyte_meta"
BUILT_AT = "dbt_updated_at"
LAST_EXTRACTED_AT = "last_extracted_at"

SCD_ID = "dbt_scd_id"
SCD_UPDATED_AT = "dbt_updated_at"
SCD_VALID_FROM = "dbt_valid_from"
SCD_VALID_TO = "dbt_valid_to"
