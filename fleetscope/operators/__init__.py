"""DataFrame -> DataFrame operators shared by the reports, the mart and the cleansing steps."""
