"""Reading, contracts, staging and writing of source and result tables."""
