"""The library applied to the order and line tables, read as supplier reports.

A line is a value that a supplier (facility) reports for a month (period). Its
return flag and line status name the element, its line number the category.
Regions, nations, balance bands and suppliers form the location tree. Some rows
get a defect, chosen by their discount and tax, so that every check has work.
"""
