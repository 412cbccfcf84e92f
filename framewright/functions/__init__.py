"""framewright.functions"""
