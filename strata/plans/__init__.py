"""Dataset-level plans: the accounts and sales layers, and job runners."""
