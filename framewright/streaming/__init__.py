"""framewright.streaming"""
