"""End-to-end plans: the column rules, the cleaning pipeline and its reports."""
