"""framewright.plans"""
