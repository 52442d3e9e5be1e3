"""The operators composed: collected pages to postings, postings to the merged table, panels."""
