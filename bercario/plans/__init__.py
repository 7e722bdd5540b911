"""The star schema, the warehouse build and the reports."""
